"""Query of the quality rules; SQL cannot express the model's verdict."""

from pyspark.sql import DataFrame, SparkSession

from .quality import COUNTS, apply_rules, train
from .registry import register, table


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = apply_rules(docs, train(docs, labels), ["doc_id"])
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "quality")
