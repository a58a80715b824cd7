"""Search over quantised codes against brute force."""

import numpy as np
from pyspark.sql import functions as F
from test_vectors import clustered, frame, similarities

from jobmill.operators import quantized as q


def best(sims, k):
    return {i: sorted(range(sims.shape[1]), key=lambda j: (-sims[i, j], j))[:k] for i in range(len(sims))}


def test_recall_and_exact_ranks(spark):
    rng = np.random.default_rng(3)
    items, asked = rng.normal(size=(1500, 32)).astype(np.float32), rng.normal(size=(30, 32)).astype(np.float32)
    got = q.quantized_topk(frame(spark, asked), frame(spark, items), 10, 32).collect()
    sims = similarities(asked, items)
    want = best(sims, 10)
    hits = sum(r["item_id"] in want[r["query_id"]] for r in got)
    assert len(got) == 300 and hits >= 270  # noise in 32 dimensions, 100 of 1,500 vectors read
    for r in got:
        assert abs(r["similarity"] - sims[r["query_id"], r["item_id"]]) < 1e-8
    for i in range(30):
        own = sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(-r["similarity"], r["item_id"]) for r in own] == sorted((-r["similarity"], r["item_id"]) for r in own)


def test_a_short_list_of_all_items_is_exact(spark, monkeypatch):
    monkeypatch.setattr(q, "CODE_ROWS", 40)
    monkeypatch.setattr(q, "TABLE_BYTES", 7 * 8 * 256 * 3)
    items = clustered(150, 12, 1, 0.3)
    df = frame(spark, items)
    got = q.quantized_topk(df, df, 5, 12, shortlist=150, skip_self=True).collect()
    sims = similarities(items, items)
    np.fill_diagonal(sims, -np.inf)
    want = best(sims, 5)
    for i in range(150):
        assert [r["item_id"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == want[i]


def test_short_lists_hold_the_best_codes(spark):
    """Codes that tie go to the smaller id, and a list is cut once for all items."""
    items = clustered(400, 8, 9, 0.6)
    df = frame(spark, items)
    index = q.build_index(df, 8)
    asked = df.filter("id % 40 = 3").select("id", F.col("embedding").alias("vector"))
    got = q._shortlists(asked, index, 7, True).collect()
    codes = {r["id"]: r["code"] for r in index.codes.collect()}
    spelled = np.stack([np.concatenate([c[b] for c, b in zip(index.centroids, codes[i], strict=True)]) for i in range(400)])
    unit = items.astype(np.float64) / np.linalg.norm(items.astype(np.float64), axis=1, keepdims=True)
    guess = np.round(unit @ spelled.T, 9)
    for i in range(3, 400, 40):
        want = sorted((j for j in range(400) if j != i), key=lambda j: (-guess[i, j], j))[:7]
        assert sorted(r["item_id"] for r in got if r["query_id"] == i) == sorted(want)


def test_rows_that_share_an_id_are_all_ranked(spark):
    rows = [("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [1.0, 0.1]), ("b", [0.2, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    got = q.quantized_topk(df, df, 20, 2, skip_self=True).collect()
    pairs = {(r["query_id"], r["item_id"]) for r in got}
    assert pairs == {("a", "b"), ("b", "a")} and len(got) == 32  # four pairs of rows, listed as often and found as often


def test_a_vector_travels_to_a_block_once(spark):
    """However many queries have an item on their list, its vector is not joined to each of them."""
    df = frame(spark, clustered(300, 8, 2, 0.0)).select("id", F.col("embedding").alias("vector"))
    pairs = spark.createDataFrame([(i, j) for i in range(300) for j in range(4)], "query_id bigint, item_id bigint")
    ranked = q._reranked(pairs, df, df, 8, 3)
    assert ranked.count() == 900
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(query_id" in plan and plan.count("Join ") == 1


def test_index_is_stored_and_extended(spark, tmp_path):
    items = clustered(200, 10, 5, 0.0)  # the last part of a vector has two components
    index = q.build_index(frame(spark, items[:150]), 10)
    assert [len(c[0]) for c in index.centroids] == [4, 4, 2] and index.codes.count() == 150
    q.write_index(q.extended(index, frame(spark, items[150:], 150)), str(tmp_path / "index"))
    again = q.read_index(spark, str(tmp_path / "index"))
    assert again.dim == 10 and again.codes.count() == 200
    asked = frame(spark, items[190:], 190)
    got = q.quantized_topk(asked, frame(spark, items), 1, 10, index=again).collect()
    assert {(r["query_id"], r["item_id"]) for r in got} == {(i, i) for i in range(190, 200)}


def test_unusable_vectors_few_items_and_none(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, None), (5, [float("nan"), 1.0]), (6, [1.0, 0.0]), (7, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>").withColumn("vector", F.lit("own"))
    got = q.quantized_topk(df, df, 5, 2)
    assert sorted((r["query_id"], r["item_id"], r["rank"]) for r in got.collect()) == [
        (1, 1, 1), (1, 6, 2), (1, 7, 3), (6, 1, 1), (6, 6, 2), (6, 7, 3), (7, 1, 2), (7, 6, 3), (7, 7, 1)
    ]
    assert q.quantized_topk(df, df.limit(0), 5, 2).collect() == []
    assert q.quantized_topk(df.limit(0), df, 5, 2).collect() == []
    assert q.extended(q.build_index(df.limit(0), 2), df).codes.count() == 3


def test_quality(spark):
    exact = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2)], "query_id int, item_id int")
    row = q.search_quality(exact, exact.limit(3), 400, 2).first()
    assert (row["expected"], row["found"], row["recall"], row["k"], row["share_read"]) == (4, 3, 0.75, 2, 0.05)
