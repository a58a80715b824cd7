import random

from llm_cases import SCHEMA, frame, odd_rows
from pyspark.sql import functions as F

from jobmill.llm import mixing


def _filled(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2.0 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return share | {s: 2.0 * sizes[s] for s in full}
        full |= over


def _mix(docs):
    sizes = docs.select(
        "doc_id", "source", mixing.text_words("text").alias("size"), mixing.draw("doc_id", "text").alias("draw")
    )
    return mixing.copies(sizes, mixing.fit(sizes))


def _docs(spark, per_source=600):
    draw = random.Random(3)
    rows = [
        (i, " ".join(["w"] * int(draw.lognormvariate(3, 1))), "aa", s, 0)
        for s, n in (("a", per_source), ("b", per_source * 3), ("c", per_source), (None, per_source), ("é", 40))
        for i in range(n)
    ]
    return frame(spark, [(i, *r[1:]) for i, r in enumerate(rows)])


def test_targets_and_bounds(spark):
    docs = _docs(spark)
    rows = _mix(docs).collect()
    sizes, taken, targets = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["__copies"]
        targets[r["source"]] = r["__target"]
        assert 0 <= r["__copies"] <= 2
    expected = _filled(sizes)
    assert len(rows) == docs.count()
    for s, words in taken.items():
        assert abs(targets[s] - expected[s]) <= 1e-6 * expected[s]
        assert abs(words - targets[s]) <= max(0.01 * targets[s], 60), s


def test_reruns_agree_and_rates_are_tilted(spark):
    docs = _docs(spark)
    a = sorted(map(str, _mix(docs).collect()))
    assert a == sorted(map(str, _mix(docs.repartition(7)).collect()))
    sizes = docs.select("source", mixing.text_words("text").alias("size"), mixing.draw("doc_id", "text").alias("draw"))
    found = {r["source"]: r for r in mixing.fit(sizes).collect()}
    for r in found.values():  # the dual's solution meets the token constraint
        own = sizes.filter(F.col("source").eqNullSafe(F.lit(r["source"]))).filter("size > 0").collect()
        if r["target"] < 2 * r["source_size"] * 0.999:
            z = [(x["size"], (x["size"] / r["mean"]) ** mixing.TILT) for x in own]
            import math

            total = sum(s * min(2.0, math.exp(r["multiplier"] * y)) for s, y in z)
            assert abs(total - r["target"]) <= 1e-5 * r["target"]


def test_odd_rows_and_empty_table(spark):
    rows = _mix(frame(spark, odd_rows())).collect()
    assert len(rows) == len(odd_rows())
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert _mix(frame(spark, [], SCHEMA)).collect() == []
    nothing = frame(spark, [(1, "", "aa", "s", 0), (2, None, "aa", None, 0)])
    assert all(r["__target"] == 0 for r in _mix(nothing).collect())


def test_size_as_defined(spark):
    docs = frame(spark, odd_rows())
    from llm_cases import SPACED

    for r in docs.select("text", mixing.text_words("text").alias("n")).collect():
        assert r["n"] == len(SPACED.findall(r["text"] or ""))
