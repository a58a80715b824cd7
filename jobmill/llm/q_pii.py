"""Query of personal data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pii import KINDS, find, train
from .registry import register, table


@register("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs), ["doc_id"])
    digest = F.sha2(F.col("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], digest, "spans")
