"""Vector search against brute force."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobmill.operators import embedding, vectors


def clustered(n, dim, seed, hot):
    """Clusters of very different size; ``hot`` of the vectors are exact copies."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    rows = centers[rng.choice(5, n, p=[0.6, 0.1, 0.1, 0.1, 0.1])] + 0.3 * rng.normal(size=(n, dim))
    rows[: int(n * hot)] = rows[0]
    return rows.astype(np.float32)


def frame(spark, matrix, start=0):
    rows = [(i + start, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id bigint, embedding array<float>")


def similarities(q, items):
    q, items = q.astype(np.float64), items.astype(np.float64)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    items = items / np.linalg.norm(items, axis=1, keepdims=True)
    return np.round(q @ items.T, vectors.DIGITS)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_topk_is_exact(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(vectors, "ITEM_BLOCK_BYTES", 23 * 96)
        monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", 7 * 96)
    items, q = clustered(300, 12, 1, 0.33), clustered(40, 12, 2, 0.1)
    got = vectors.vector_topk(frame(spark, q), frame(spark, items), 5, 12, pivots=9).collect()
    sims = similarities(q, items)
    for i in range(len(q)):
        want = sorted(range(len(items)), key=lambda j: (-sims[i, j], j))[:5]
        mine = [r["item_id"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])]
        assert mine == want


def test_a_task_hands_on_the_best_of_a_query_once(spark, monkeypatch):
    """However many cells a query visits and whatever the order, null and equal ids stay apart."""
    monkeypatch.setattr(vectors, "BLOCK_RESULTS", 60)
    monkeypatch.setattr(vectors, "PAIRS_AT_ONCE", 50)
    items, q = clustered(300, 12, 1, 0.33), clustered(40, 12, 2, 0.1)
    known = frame(spark, items).withColumn("id", F.concat(F.lit("p"), F.lpad("id", 3, "0")))
    known = known.unionByName(known.filter("id < 'p003'").withColumn("id", F.lit(None).cast("string")))
    parts = [vectors._usable(x, "id", "embedding", 12) for x in (frame(spark, q), known)]
    found = vectors._search(*parts, 12, k=5, pivots=9)
    groups = -(-2 * spark.sparkContext.defaultParallelism // 4)  # four blocks of at most 12 queries
    assert found.count() <= 40 * 5 * groups
    sims = similarities(q, np.concatenate([items, items[:3]]))
    names = [f"p{i:03}" for i in range(300)] + [None] * 3
    best = vectors._best(found, 5).collect()
    for i in range(40):
        got = sorted(round(r["similarity"], 9) for r in best if r["query_id"] == i)
        assert got == sorted(np.sort(sims[i])[-5:].round(9).tolist())
        for r in (r for r in best if r["query_id"] == i):
            assert any(n == r["item_id"] and abs(sims[i, j] - r["similarity"]) < 1e-8 for j, n in enumerate(names))


def test_few_pairs_are_compared_in_double_precision(monkeypatch):
    """Single precision keeps most pairs away; ties, equal ids and vectors that are no unit count."""
    rng = np.random.default_rng(8)
    asked, items = (rng.normal(size=(n, 24)) for n in (60, 3000))
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    items[2000:2400] = asked[0] * 0.7 + items[2000] * 0.2
    names, ids = np.arange(60) // 2, rng.permutation(3000) // 2
    counted = []
    products = vectors._products
    monkeypatch.setattr(vectors, "_products", lambda a, i, b, j: counted.append(len(i)) or products(a, i, b, j))
    monkeypatch.setattr(vectors, "ITEM_BLOCK_BYTES", 128 * 8 * 24)
    block = vectors._Block(pd.DataFrame({"id": names, "vector": list(asked)}), 5, True, None)
    for lo in range(0, 3000, 128):
        cut = slice(lo, lo + 128)
        block.add(0, ids[cut], np.zeros(len(ids[cut]), bool), items[cut])
    block.cut()
    query, sims, found, _ = block.parts[0]
    unit = asked / np.linalg.norm(asked, axis=1, keepdims=True)
    exact = np.round(unit @ items.T, vectors.DIGITS)
    for name in range(30):
        own = [(-exact[i, j], ids[j]) for i in (2 * name, 2 * name + 1) for j in range(3000) if ids[j] != name]
        mine = [(-s, f) for q, s, f in zip(query, sims, found, strict=True) if q == 2 * name]
        assert mine == sorted(own)[:5]
    assert sum(counted) < 60 * 3000 / 10


def test_no_task_gets_two_blocks(spark):
    items, q = clustered(90, 12, 1, 0.0), clustered(40, 12, 2, 0.0)
    parts = [vectors._usable(frame(spark, x), "id", "embedding", 12) for x in (q, items)]
    found = vectors._search(*parts, 12, k=2, pivots=3)
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() == tasks
    counts = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert min(counts) > 0


def test_pruning_skips_cells(spark):
    items = clustered(300, 12, 1, 0.0)
    cells = vectors._Cells(vectors._usable(frame(spark, items), "id", "embedding", 12), 3, 16, 12)
    queries = vectors._usable(frame(spark, items[:30]), "id", "embedding", 12)
    visits = vectors._visits(queries, cells, 3, None, None).count()
    assert visits < 30 * len(cells.stats)


def test_score_matches_is_exact(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ITEM_BLOCK_BYTES", 31 * 96)
    items, q = clustered(200, 12, 3, 0.3), clustered(25, 12, 4, 0.0)
    people = frame(spark, q).withColumnRenamed("embedding", "resume_embedding")
    got = vectors.score_matches(people, frame(spark, items), 12, "C", pivots=7).collect()
    sims = similarities(q, items)
    want = {(i, j) for i in range(len(q)) for j in range(len(items)) if sims[i, j] > 0.65}
    assert {(r["user_id"], r["job_id"]) for r in got} == want and len(got) == len(want)
    assert {r["grade"] for r in got} <= {"A", "B", "C"}


def test_bad_vectors_are_left_out(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, None)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    got = vectors.vector_topk(df.filter("id = 1"), df, 3, 2).collect()
    assert [(r["query_id"], r["item_id"]) for r in got] == [(1, 1)]


def test_sizes_do_not_depend_on_the_first_row(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, float(i), 0.5]) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>").coalesce(1)
    got = vectors.vector_topk(df.filter("id = 3"), df, 3, 3).collect()
    assert len(got) == 3
    left = vectors.rejected_vectors(df, "id", "embedding", 3).collect()
    assert [(r["id"], r["reason"]) for r in left] == [(0, "size")]


def test_pivots_are_honoured_or_refused(spark):
    df = frame(spark, clustered(40, 4, 6, 0.0))
    with pytest.raises(ValueError):
        vectors.vector_topk(df, df, 1, 4, pivots=1 << 22)


def test_scores_keep_the_best_of_each_profile(spark):
    items, q = clustered(60, 12, 3, 0.0), clustered(9, 12, 4, 0.0)
    people = frame(spark, q).withColumnRenamed("embedding", "resume_embedding")
    got = vectors.score_matches(people, frame(spark, items), 12, "F", k=4).collect()
    sims = similarities(q, items)
    want = {(i, j) for i in range(9) for j in sorted(range(60), key=lambda j: (-sims[i, j], j))[:4]}
    assert {(r["user_id"], r["job_id"]) for r in got} == want


def test_probing_finds_most(spark):
    items = clustered(300, 12, 5, 0.0)
    df = frame(spark, items)
    exact = vectors.vector_topk(df, df, 5, 12, pivots=12, skip_self=True)
    approx = vectors.vector_topk_approx(df, df, 5, 12, probes=4, pivots=12, skip_self=True)
    assert vectors.recall_report(exact, approx).first()["recall"] > 0.8


def queue_jobs(spark):
    rows = [
        ("c", "A", "Austin, TX", "new_grad", False), ("b", "B", "Austin, TX", "new_grad", True),
        ("a", "C", "Oslo", "new_grad", True), ("d", "", None, "entry_level", True), ("e", "E", "Remote", "entry_level", True),
    ]
    df = spark.createDataFrame(rows, "id string, title string, location string, experience_level string, is_active boolean")
    return df.withColumns({"description": F.lit(None).cast("string"), "embedding": F.lit(None).cast("array<float>")})


def test_queue_order_and_short_batches(spark):
    queue = embedding.embedding_queue(queue_jobs(spark))
    got = [(r["id"], r["priority"]) for r in queue.orderBy("rank").collect()]
    assert got == [("b", 1), ("d", 2), ("e", 2), ("a", 3), ("c", 3)]
    batches = embedding.embedding_batches(queue, size=2).orderBy("rank").collect()
    assert [(r["id"], r["batch_no"], r["position"]) for r in batches] == [("b", 1, 0), ("e", 2, 0), ("a", 2, 1), ("c", 3, 0)]


def test_broken_batches_are_rejected(spark):
    batches = embedding.embedding_batches(embedding.embedding_queue(queue_jobs(spark)), size=2)
    whole = embedding.embed(batches, embedding.hashing_embedder(4))
    assert embedding.attach_embeddings(batches, whole, 4).count() == 4
    assert embedding.attach_embeddings(batches, whole.filter("NOT (batch_no = 2 AND position = 0)"), 4).count() == 2
    assert embedding.attach_embeddings(batches, whole, 5).count() == 0


def test_words_are_hashed_once(spark):
    embedder = embedding.hashing_embedder(16)
    df = spark.createDataFrame([("a B  a c",), ("",), (None,)], "input string").select(embedder(F.col("input")).alias("v"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("md5(") == 1
    want = np.zeros(16)
    for word in "a b a c".split():
        code = hashlib.md5(word.encode()).hexdigest()
        want[int(code[:4], 16) % 16] += 1 - 2 * (int(code[4], 16) % 2)
    got = [r["v"] for r in df.collect()]
    assert np.allclose(got[0], want / np.linalg.norm(want)) and got[1] == [0.0] * 16
