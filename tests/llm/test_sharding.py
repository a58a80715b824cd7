import zlib

from llm_cases import SCHEMA, clashing, frame, odd_rows, prose

from jobmill.llm import sharding


def _check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {k: sum(r["size"] for r in own) for k, own in by.items()}


def test_even_and_together(spark):
    rows = [(i, prose(f"d{i % 700}", 20 + i % 90), "aa", "s", 0) for i in range(700)]
    rows += [(700 + i, rows[i % 40][1], "aa", "s", 0) for i in range(120)]
    docs = clashing(frame(spark, rows), "size", "slot", "part", "bytes")
    found = sharding.shard(docs, ["doc_id", "text", "part"], 8).collect()
    sizes = _check(found, 8)
    assert len(found) == len(rows) and len(sizes) == 8
    mean = sum(sizes.values()) / 8
    assert max(abs(x - mean) for x in sizes.values()) < 0.03 * mean
    places = {}
    for r in found:
        places.setdefault(r["text"], set()).add(r["shard"])
        assert r["size"] == len(r["text"].encode()) + 8
        assert r["text_crc32"] == zlib.crc32(r["text"].encode())
    assert sum(len(p) > 1 for p in places.values()) <= 2


def test_a_hot_text_is_spread(spark):
    rows = [(i, "the same hot text " * 10, "aa", "s", 0) for i in range(300)]
    rows += [(300 + i, prose(f"x{i}", 40), "aa", "s", 0) for i in range(400)]
    sizes = _check(sharding.shard(frame(spark, rows), ["doc_id"], 6).collect(), 6)
    mean = sum(sizes.values()) / 6
    assert max(abs(x - mean) for x in sizes.values()) < 0.05 * mean


def test_reruns_agree(spark):
    rows = [(i, prose(f"r{i % 90}", 30), "aa", "s", 0) for i in range(200)]
    a = sharding.shard(frame(spark, rows), ["doc_id"], 5).orderBy("doc_id").collect()
    b = sharding.shard(frame(spark, rows).repartition(3), ["doc_id"], 5).orderBy("doc_id").collect()
    assert a == b


def test_odd_rows_and_empty_table(spark):
    found = sharding.shard(frame(spark, odd_rows()), ["doc_id", "text"], 3).collect()
    assert len(found) == len(odd_rows())
    _check(found, 3)
    assert {r["size"] for r in found if not r["text"]} == {8}
    assert sharding.shard(frame(spark, [], SCHEMA), ["doc_id"]).collect() == []


def test_equal_rows_are_dealt_out(spark):
    rows = [(i, prose(f"e{i}", 40), "aa", "s", 0) for i in range(400)]
    rows += [(7_000, "one row " * 21, "aa", "s", 0)] * 3000
    sizes = _check(sharding.shard(frame(spark, rows), ["doc_id"], 6).collect(), 6)
    mean = sum(sizes.values()) / 6
    assert len(sizes) == 6
    assert max(abs(x - mean) for x in sizes.values()) < 0.05 * mean


def test_few_pairs_are_cut(spark):
    rows = [(i, prose(f"p{i % 1000}", 30), "aa", "s", 0) for i in range(2000)]
    found = sharding.shard(frame(spark, rows), ["text"], 6)
    report = sharding.cut_report(found, "text").first()
    assert (report["groups"], report["links"]) == (1000, 1000)
    assert report["cut_groups"] < 50 and report["cut_links"] == report["cut_groups"]
    sizes = _check(found.collect(), 6)
    mean = sum(sizes.values()) / 6
    assert max(abs(x - mean) for x in sizes.values()) < 0.01 * mean


def test_groups_that_fit_stay_whole(spark):
    rows = [(i, f"group {i % 30} " * (10 + i % 30), "aa", "s", 0) for i in range(600)]
    rows += [(600 + i, prose(f"g{i}", 60), "aa", "s", 0) for i in range(900)]
    found = sharding.shard(frame(spark, rows), ["text"], 4)
    report = sharding.cut_report(found, "text").first()
    assert report["groups"] == 30 and report["cut_groups"] == 0
    sizes = _check(found.collect(), 4)
    mean = sum(sizes.values()) / 4
    assert max(abs(x - mean) for x in sizes.values()) < 0.02 * mean


def test_places_from_many_bins(spark):
    rows = [(s, b, (b * 7 + s) % 5 + 1) for s in range(2) for b in range(0, 5000, 3)]
    found = sharding._begins(spark.createDataFrame(rows, "shard int, __bin int, total long"), "shard")
    at = {(r["shard"], r["__bin"]): r["begin"] for r in found.collect()}
    for s in range(2):
        total = 0
        for b in range(0, 5000, 3):
            assert at[s, b] == total
            total += (b * 7 + s) % 5 + 1
