import random

import pytest
from pyspark.sql import functions as F

from jobmill.llm import clustering
from jobmill.llm.clustering import inertia, lloyd, packed, unpacked

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, size, scale, clusters, rounds):
    """Lloyd over whole vectors in plain integers; ``rows`` are (id, order, vector)."""
    ints = [(i, o, [int((x * scale) // 1) for x in v]) for i, o, v in rows]
    centroids = [v for _, _, v in sorted(ints, key=lambda r: (r[1] is None, r[1], r[2]))[:clusters]]
    for left in range(rounds, -1, -1):
        found = []
        for _, _, v in ints:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((apart.index(min(apart)), min(apart)))
        if left:
            for k in range(len(centroids)):
                own = [v for (_, _, v), (c, _) in zip(ints, found, strict=True) if c == k]
                if own:
                    centroids[k] = [sum(xs) // len(own) for xs in zip(*own, strict=True)]
    return [(i, *f) for (i, _, _), f in zip(ints, found, strict=True)], centroids


def table(spark, n, size, seed=1):
    draw = random.Random(seed)
    rows = [(i, [round(draw.uniform(-3, 3) * 256) / 256 for _ in range(size)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("limit", [clustering.BROADCAST_BYTES, 0])
def test_as_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(clustering, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(clustering, "CHUNK", 37)
    rows, df = table(spark, 300, 10)
    order = F.pmod(F.col("vec_id") * 7919, F.lit(300))
    found = lloyd(df, ["vec_id"], order, size=10, scale=16, clusters=7, rounds=3, blocks=3)
    want, centroids = brute_force([(i, i * 7919 % 300, v) for i, v in rows], 10, 16, 7, 3)
    assert sorted(map(tuple, found.members.collect())) == sorted(want)
    assert [list(r[1]) for r in sorted(found.centroids.collect())] == centroids
    whole = inertia(found).collect()
    assert {r.inertia for r in whole} == {sum(d for _, _, d in want)}
    assert {(r.cluster, r.cluster_inertia) for r in whole} == {
        (k, sum(d for _, c, d in want if c == k)) for k in {c for _, c, _ in want}
    }


def test_unusable_vectors_ties_and_repeats(spark):
    rows = [
        (1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (None, [0.25, 0.0]),
        (4, None), (5, [1.0]), (6, [1.0, None]), (7, [float("nan"), 0.0]), (8, [float("inf"), 0.0]), (9, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("row", "cluster_", "kept", "block")})
    found = lloyd(df, ["vec_id", "row", "kept", "block"], F.col("vec_id"), size=2, scale=4, clusters=3, rounds=0)
    got = [tuple(r) for r in found.members.drop("row", "kept", "block").collect()]
    # centroids are (0, 0), (4, 0) and again (4, 0); 3 is as far from the first as from the second
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == [(1, 0, 0), (2, 1, 0), (2, 1, 0), (3, 0, 4), (None, 0, 1)]
    assert {r[1] for r in found.members.collect()} == {"own"}


def test_few_none_and_far(spark):
    rows, df = table(spark, 2, 4)
    found = lloyd(df, ["vec_id"], F.col("vec_id"), size=4)
    assert sorted(map(tuple, found.members.collect())) == [(0, 0, 0), (1, 1, 0)]
    none = lloyd(df.limit(0), ["vec_id"], F.col("vec_id"), size=4)
    assert inertia(none).collect() == []
    far = spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        lloyd(far, ["vec_id"], F.col("vec_id"), size=2).members.collect()


def test_empty_cluster_keeps_its_centroid(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [9.0])], SCHEMA)
    found = lloyd(df, ["vec_id"], F.col("vec_id"), size=1, scale=1, clusters=3, rounds=2)
    assert sorted(map(tuple, found.members.collect())) == [(1, 0, 0), (2, 0, 0), (3, 2, 0)]
    assert sorted((k, list(c)) for k, c in found.centroids.collect()) == [(0, [0]), (1, [0]), (2, [9])]


def test_packing_is_exact():
    import numpy as np

    for edge in (1, 127, 128, -128, -129, 40_000, 1 << 30, 1 << 40, -(1 << 62)):
        matrix = np.array([[edge, 0], [1, -1]])
        assert (unpacked(packed(matrix), 2) == matrix).all()
