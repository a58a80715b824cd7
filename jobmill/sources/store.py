"""Snapshot storage, one folder per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, salt: int = 1) -> None:
    """Write a new snapshot, partitioned by source.

    With ``salt`` > 1 each source is written by that many tasks, so that a source with a
    third of the rows does not end up in one.
    """
    if salt > 1:
        df = df.repartition("source", F.pmod(F.xxhash64("dedup_hash"), F.lit(salt)))
    df.write.mode("errorifexists").partitionBy("source").parquet(path)


def read_snapshot(spark: SparkSession, path: str, sources: Sequence[str] = ()) -> DataFrame:
    """Read a snapshot; naming sources reads only their folders."""
    df = spark.read.parquet(path)
    return df.filter(F.col("source").isin(list(sources))) if sources else df
