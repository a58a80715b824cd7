"""Query of source mixing; SQL cannot express the Newton steps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import copies, draw, fit, text_words
from .registry import register, table
from .store import rewritten


@register("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = rewritten(
        docs.select("doc_id", "source", text_words("text").alias("size"), draw("doc_id", "text").alias("draw")),
        "sizes",
    )
    mixed = copies(sizes, fit(sizes))
    return mixed.select(
        "doc_id",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("size")).alias("taken"),
    )
