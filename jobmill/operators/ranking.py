"""Positions in a total order, without passing all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def global_rank(df: DataFrame, order_by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in the order.

    Rows are range-partitioned by the order, counted per partition, and numbered inside
    each partition; only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = durable(
        df.repartitionByRange(parts, *order_by).withColumn("_part", F.spark_partition_id())
    )
    offset, offsets = 0, []
    for row in ranged.groupBy("_part").count().orderBy("_part").collect():
        offsets.append((row["_part"], offset))
        offset += row["count"]
    starts = spark.createDataFrame(offsets, "_part int, _start bigint")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_part", "_start")
    )
