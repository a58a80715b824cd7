"""Query of toxicity; SQL cannot express the model."""

from pyspark.sql import DataFrame, SparkSession

from .registry import register, table
from .spans import held_out
from .toxicity import toxicity, train


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, eligible=~held_out("id"))
    found = toxicity(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
