from llm_cases import frame, prose
from pyspark.sql import functions as F

from jobmill.llm.labelled import labelled_sample

LABELS = "doc_id long, toxic int"


def test_copies_of_a_document_do_not_enlarge_the_sample(spark):
    rows = [(i, prose(i, 8), "aa", "s", 0) for i in range(60)]
    copies = frame(spark, [(1, "b the same id", "aa", "s", 0)]).crossJoin(spark.range(4000)).drop("id")
    docs = frame(spark, rows).unionByName(copies)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 3, LABELS)
    sample, counts = labelled_sample(docs, labels, "toxic", 20, F.lit(True))
    assert counts == {0: 30, 1: 30}
    assert sample.groupBy("label").count().orderBy("label").collect() == [(0, 20), (1, 20)]
    everything, _ = labelled_sample(docs, labels, "toxic", 30, F.lit(True))
    texts = {r["text"] for r in everything.collect()}
    least = min(prose(1, 8), "b the same id")
    assert len(texts) == 60 and least in texts
    assert labelled_sample(docs.limit(0), labels, "toxic", 20, F.lit(True))[0].collect() == []
