"""Query of near-duplicate classes; SQL cannot express the sampling."""

from pyspark.sql import DataFrame, SparkSession

from .neardup import near_duplicate_classes
from .registry import register, table


@register("op9_near_duplicates")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), ["doc_id"])
