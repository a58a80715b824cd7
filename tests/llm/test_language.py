from llm_cases import SCHEMA, clashing, frame, odd_rows, prose
from pyspark.sql import functions as F

from jobmill.llm import language
from jobmill.llm.spans import bounded_sample, held_out

TONGUES = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "mnopqrst"}


def _docs(spark):
    rows = [
        (i, prose(f"{x}{i}", 5 + i % 60, letters=letters), x, f"s{i % 3}", i)
        for n, (x, letters) in enumerate(TONGUES.items())
        for i in range(n * 100, n * 100 + 100)
    ]
    return frame(spark, rows)


def test_held_out_accuracy(spark):
    docs = _docs(spark)
    model = language.train(docs.filter(~held_out()))
    rows = language.identify(docs, model, ["doc_id", "lang"]).withColumn("h", held_out()).collect()
    held = [r for r in rows if r["h"]]
    assert len(rows) == 300 and len(held) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_and_ids_are_no_input(spark):
    docs = _docs(spark)
    model = language.train(docs)
    changed = docs.withColumns({"lang": F.lit("zz"), "doc_id": F.col("doc_id") + 7, "source": F.lit("x")})
    a = language.identify(docs, model, ["text"]).orderBy("text").collect()
    b = language.identify(changed, model, ["text"]).orderBy("text").collect()
    assert a == b


def test_odd_rows_and_clashing_columns(spark):
    docs = clashing(_docs(spark).unionByName(frame(spark, odd_rows())), "lang_pred", "score", "label")
    model = language.train(docs)
    rows = language.identify(docs, model, docs.columns).filter("n_chars < 9 OR n_chars IS NULL").collect()
    unknown = {r["text"] for r in rows if r["lang_pred"] == "und"}
    assert {None, "", "!!! ... ???"} <= unknown and "one" not in unknown
    assert all(r["score"] == 0.0 for r in rows if r["lang_pred"] == "und")


def test_empty_tables(spark):
    empty = frame(spark, [], SCHEMA)
    assert language.train(empty) is None
    assert language.identify(empty, None, ["doc_id"]).collect() == []
    one = frame(spark, [(1, "words", "aa", "s", 1)])
    assert [r["lang_pred"] for r in language.identify(one, None, ["doc_id"]).collect()] == ["und"]


def test_copies_weigh_once(spark):
    docs = _docs(spark)
    hot = docs.filter("doc_id = 0").crossJoin(spark.range(500)).drop("id")
    a, b = language.train(docs), language.train(docs.unionByName(hot))
    assert abs(a.weights - b.weights).max() < 1e-4


def test_copies_do_not_thin_other_texts(spark):
    texts = spark.range(300).selectExpr("'aa' AS lang", "concat('text ', id) AS text")
    hot = spark.range(200_000).selectExpr("'aa' AS lang", "'hot' AS text")
    kept = bounded_sample(texts.unionByName(hot), "text", "lang", 100).collect()
    whole = bounded_sample(texts.unionByName(hot), "text", "lang", 1500).collect()
    assert len(whole) == 301 and len(kept) == 100
    assert {r["text"] for r in kept} == {r["text"] for r in sorted(whole, key=lambda r: r["key"])[:100]}


def test_the_bound_holds_beyond_its_triple(spark):
    many = spark.range(5000).selectExpr("'aa' AS lang", "concat('text ', id) AS text")
    kept = bounded_sample(many, "text", "lang", 50).collect()
    keys = sorted(r[0] for r in many.selectExpr("xxhash64(text)").collect())
    assert sorted(r["key"] for r in kept) == keys[:50]
