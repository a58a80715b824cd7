from llm_cases import SCHEMA, clashing, frame, odd_rows, plain_words, prose

import corpus_pipeline as pipeline

A, B = "abcdefgh", "klmnopqr"


def _docs(spark):
    rows = [(i, prose(f"p{i}", 40 + i % 50, letters=A if i % 2 else B), "aa" if i % 2 else "bb", f"s{i % 4}", i) for i in range(240)]
    base = rows[10][1].split()
    rows += [(300 + i, " ".join([*base[:-1], f"end{i}"]), "bb", "s1", 0) for i in range(3)]
    rows += [(310, rows[11][1], "aa", "s2", 0), (311, "12 34 !!", "aa", "s2", 0)]
    item = prose("item", 30, letters=A)
    rows += [(320, rows[13][1] + " " + " ".join(item.split()[4:18]), "aa", "s0", 0)]
    return rows, item


def test_stages(spark, tmp_path):
    rows, item = _docs(spark)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = clashing(frame(spark, rows), "score", "size", "n_words", "class_id", "draw")
    seen = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, pipeline.rewritten(stage(spark, docs, str(tmp_path)), f"test-{name}")
        seen[name] = {r["doc_id"] for r in docs.collect()}
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns, name
    assert 311 not in seen["language_id"] and len(seen["language_id"]) >= len(rows) - 2
    assert not seen["near_duplicates"] & {300, 301, 302, 310}
    assert 320 in seen["near_duplicates"] and 320 not in seen["decontaminate"]
    assert seen["near_duplicates"] - seen["decontaminate"] == {320}
    assert seen["mix_sources"] == seen["shards"]
    assert docs.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert plain_words("A b") == ["a", "b"]


def test_odd_and_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd_rows(), []):
        docs = frame(spark, rows, SCHEMA)
        for name, stage in pipeline.STAGES:
            docs = pipeline.rewritten(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.count() <= 2 * len(rows)


def test_run_reads_documents(spark, tmp_path):
    rows, item = _docs(spark)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = pipeline.run(spark, str(tmp_path)).collect()
    assert found and {r["law"] for r in found} == {"bytes"}
