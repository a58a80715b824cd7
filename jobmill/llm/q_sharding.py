"""Query of sharding; SQL cannot express the rounds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import register, table
from .sharding import shard


def located(found: DataFrame) -> DataFrame:
    """Where each document lies, under the law of near-equal bytes."""
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(shard(table(spark, sf_dir, "documents"), ["doc_id"]))
