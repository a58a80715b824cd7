"""Order-dependent operators against step-by-step models, and properties."""

import random

import pytest
from pyspark.sql import functions as F

from jobmill.operators import dedup, merge


def greedy_model(rows, limit):
    seen, kept = set(), []
    for row_id, row_keys in rows:
        if len(kept) == limit:
            break
        if seen.isdisjoint(row_keys):
            seen |= set(row_keys)
            kept.append(row_id)
    return kept


def test_rows_without_keys_come_once(spark):
    rows = [("u", i, []) for i in range(5)]
    df = spark.createDataFrame(rows, "u string, pos int, keys array<string>")
    out = dedup.greedy_dedupe(df, ["u"], [F.col("pos")], "keys", 4, batch=2).collect()
    assert sorted((r["keep_rank"], r["pos"]) for r in out) == [(1, 0), (2, 1), (3, 2), (4, 3)]


@pytest.mark.parametrize("batch", [3, 200])
def test_greedy_dedupe_equals_a_scan(spark, batch):
    rng = random.Random(7)
    rows = []
    for user in range(6):
        size = 120 if user == 0 else rng.randrange(1, 25)
        for pos in range(size):
            # A third of all rows are copies of one posting.
            keys = ["copy", f"u{pos}"] if rng.random() < 0.34 else [f"k{rng.randrange(30)}" for _ in range(3)]
            rows.append((user, pos, keys))
    df = spark.createDataFrame(rows, "u int, pos int, keys array<string>").repartition(5)
    out = dedup.greedy_dedupe(df, ["u"], [F.col("pos")], "keys", 4, batch=batch).collect()
    for user in range(6):
        want = greedy_model([(p, k) for u, p, k in rows if u == user], 4)
        got = sorted((r["keep_rank"], r["pos"]) for r in out if r["u"] == user)
        assert [p for _, p in got] == want
        assert [k for k, _ in got] == list(range(1, len(want) + 1))


def test_a_dropped_row_frees_its_keys(spark):
    df = spark.createDataFrame([(1, 1, ["a", "x"]), (1, 2, ["a", "y"]), (1, 3, ["y", "z"])], "u int, pos int, keys array<string>")
    out = dedup.greedy_dedupe(df, ["u"], [F.col("pos")], "keys", 10)
    assert sorted(r["pos"] for r in out.collect()) == [1, 3]


def test_cross_source_dedup_keeps_other_sources_and_blank_urls(spark):
    rows = [
        ("pittcsc", "https://a/", 1, 1), ("zapplyjobs", "https://a", 2, 1), ("greenhouse", "https://a", 3, 1),
        ("zapplyjobs", " ", 2, 2), ("zapplyjobs", "", 2, 3), ("pittcsc", "https://a", 1, 4),
    ]
    df = spark.createDataFrame(rows, "source string, url string, source_rank int, ingest_seq int")
    out = dedup.dedupe_across_sources(df)
    assert sorted((r["source"], r["ingest_seq"]) for r in out.collect()) == [
        ("greenhouse", 1), ("pittcsc", 1), ("zapplyjobs", 2), ("zapplyjobs", 3),
    ]
    again = dedup.dedupe_across_sources(out)
    assert again.count() == out.count()


def merge_model(current, batch):
    """Sources write one after another."""
    jobs = {h: dict(source=s, posted=p) for h, s, p in current}
    ranked = sorted({(r, s) for _, s, r, _, _ in batch})
    for rank, source in ranked:
        last = {}
        for h, s, r, seq, p in sorted(batch, key=lambda x: x[3]):
            if s == source:
                last[h] = p
        for h, p in last.items():
            old = jobs.get(h)
            if old is not None and old["source"] != source:
                newer = (p or 0) > (old["posted"] or 0)
                p = p if newer else (old["posted"] if old["posted"] is not None else p)
            jobs[h] = dict(source=source, posted=p)
    return {h: (j["source"], j["posted"]) for h, j in jobs.items()}


def test_merge_equals_sequential_writes(spark):
    rng = random.Random(3)
    names = ["s1", "s2", "s3"]
    current = [(f"h{i}", rng.choice(names), rng.choice([None, rng.randrange(1, 9)])) for i in range(40)]
    batch = []
    for seq in range(220):
        rank = rng.randrange(3)
        batch.append((f"h{rng.randrange(80)}", names[rank], rank, seq, rng.choice([None, rng.randrange(1, 9)])))
    stamp = lambda c: F.timestamp_seconds(F.col(c) * 86400)
    cur = spark.createDataFrame(current, "dedup_hash string, source string, p int").select(
        "dedup_hash", "source", stamp("p").alias("posted_at"), F.concat(F.lit("id-"), "dedup_hash").alias("id"),
        F.lit(None).cast("timestamp").alias("scraped_at"), F.lit(False).alias("is_active"),
    )
    new = spark.createDataFrame(batch, "dedup_hash string, source string, source_rank int, ingest_seq int, p int").select(
        "dedup_hash", "source", "source_rank", "ingest_seq", stamp("p").alias("posted_at")
    )
    merged = merge.merge_snapshot(cur, new, F.lit("2026-01-01").cast("timestamp"))
    rows = merged.withColumn("p", F.unix_timestamp("posted_at") / 86400).collect()
    want = merge_model(current, batch)
    assert {r["dedup_hash"]: (r["source"], None if r["p"] is None else int(r["p"])) for r in rows} == want
    assert len(rows) == len(want)
    old = {h for h, _, _ in current}
    written = {b[0] for b in batch}
    for r in rows:
        assert r["is_active"] == (r["dedup_hash"] in written)
        assert (r["id"] == "id-" + r["dedup_hash"]) == (r["dedup_hash"] in old)
    twice = merge.merge_snapshot(merged, new, F.lit("2026-01-01").cast("timestamp"))
    assert twice.count() == len(want)


GUARDS = [
    (8610, 6796, 1814, "retire"), (200, 99, 0, "skip_low_fresh"), (100, 10, 90, "skip_high_stale"),
    (50, 40, 0, "skip_inconsistent"), (40, 40, 0, "nothing_stale"), (30, 0, 30, "skip_empty"),
]


@pytest.mark.parametrize(("active", "fresh", "stale", "want"), GUARDS)
def test_guards(spark, active, fresh, stale, want):
    """Tables built so that the counts come out as given."""
    ids = spark.range(active).select(F.col("id").cast("string").alias("dedup_hash"))
    # Hashes from `stale` on are delivered again; the rest of the fresh ones belong elsewhere.
    first = stale if stale else 0
    delivered = spark.range(first, first + fresh).select(F.col("id").cast("string").alias("dedup_hash"))
    if want == "skip_inconsistent":
        # Two rows share each hash: fewer fresh hashes than active rows, none of them stale.
        ids = ids.withColumn("dedup_hash", (F.col("dedup_hash").cast("int") % fresh).cast("string"))
    merged = ids.withColumns({"source": F.lit("x"), "is_active": F.lit(True)})
    batch = delivered.withColumn("source", F.lit("x"))
    status = spark.createDataFrame([("x", True)], "source string, success boolean")
    row = merge.retirement_guards(merged, batch, status).first()
    assert (row["active"], row["fresh"]) == (active, fresh)
    assert row["decision"] == want


def test_failed_and_partial_sources_are_left_alone(spark):
    merged = spark.createDataFrame([("a", "h", True), ("jobspy", "h", True)], "source string, dedup_hash string, is_active boolean")
    batch = merged.filter("false").select("source", "dedup_hash")
    status = spark.createDataFrame([("a", False), ("jobspy", True)], "source string, success boolean")
    rows = merge.retirement_guards(merged, batch, status).collect()
    assert {r["decision"] for r in rows} == {"not_considered"}


def test_probe_state_counts_down_and_resets(spark):
    targets = "map<string,struct<wd_version:string,slug:string>>"
    state = spark.createDataFrame(
        [("skip", 3, {}), ("tried", 0, {"a": ("wd1", "a")}), ("gone", 0, {})],
        f"company string, zero_count int, known_targets {targets}",
    ).withColumns({"last_attempt": F.lit(None).cast("date"), "wd_version": F.lit(None).cast("string"), "slug": F.lit(None).cast("string")})
    results = spark.createDataFrame(
        [("tried", 0, 0, False, False, True, {}), ("slow", 0, 0, True, False, True, {}), ("new", 5, 9, False, True, False, {"b": ("wd5", "b")})],
        f"company string, jobs int, raw_jobs int, had_timeout boolean, had_success boolean, had_error boolean, known_targets {targets}",
    ).withColumns({"wd_version": F.lit(None).cast("string"), "slug": F.lit(None).cast("string")})
    out = merge.update_probe_state(state, results, F.lit("2026-01-01").cast("date")).collect()
    assert {r["company"]: r["zero_count"] for r in out} == {"skip": 2, "tried": 3, "new": 0}


def test_results_do_not_depend_on_partitions(spark):
    rows = [(f"h{i % 50}", f"s{i % 3}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "dedup_hash string, source string, ingest_seq int")
    seen = set()
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out = dedup.dedupe_in_source(df.repartition(int(parts))).collect()
        seen.add(frozenset((r["source"], r["dedup_hash"], r["ingest_seq"]) for r in out))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS o")
    plan = dedup.dedupe_by(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
