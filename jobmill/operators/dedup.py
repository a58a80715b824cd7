"""Layered duplicate removal.

Arrival order decides which copy survives, so each operator takes the order as columns.
Hot keys are safe: a ``row_number() = 1`` filter makes Spark cut each key to one row per
map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_url
from ..session import durable

# Sources that copy each other's lists.
CURATED_SOURCES = [
    "pittcsc", "simplify_internships", "vanshb03_newgrad", "vanshb03_internships",
    "ambicuity", "speedyapply_swe", "speedyapply_ai", "speedyapply_ai_newgrad",
    "speedyapply_swe_newgrad", "jobright_swe", "jobright_data", "jobright_business",
    "jobright_design", "jobright_marketing", "jobright_accounting", "jobright_pm",
    "zapplyjobs",
]


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_rows(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key."""
    window = Window.partitionBy(*map(_column, keys)).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def dedupe_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str],
    keep: str = "first",
) -> DataFrame:
    """One row per key: the first or the last one in the order."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by]
    return first_rows(df, keys, order)


def dedupe_in_source(df: DataFrame, order_by: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """One row per source and hash; the last one wins."""
    return dedupe_by(df, ["source", "dedup_hash"], order_by, keep="last")


def dedupe_across_sources(
    df: DataFrame,
    group: Sequence[str] = CURATED_SOURCES,
    order_by: Sequence[str] = ("source_rank", "ingest_seq"),
) -> DataFrame:
    """Inside the group a URL stays with its earliest source.

    Blank URLs and sources outside the group pass through without a shuffle.
    """
    key = F.coalesce(canonical_url(F.col("url")), F.lit(""))
    shared = F.col("source").isin(list(group)) & (key != "")
    kept = dedupe_by(df.filter(shared), [key], order_by)
    return kept.unionByName(df.filter(~F.coalesce(shared, F.lit(False))))


def duplicate_report(df: DataFrame, group: Sequence[str] = CURATED_SOURCES) -> DataFrame:
    """Per source: rows, rows lost to earlier sources, hashes other sources also have."""
    kept = dedupe_across_sources(df, group).groupBy("source").agg(F.count("*").alias("kept"))
    totals = df.groupBy("source").agg(F.count("*").alias("n_rows"))
    shared = (
        df.groupBy("dedup_hash")
        .agg(F.collect_set("source").alias("sources"))
        .filter(F.size("sources") > 1)
        .select(F.explode("sources").alias("source"))
        .groupBy("source")
        .agg(F.count("*").alias("shared_hashes"))
    )
    zero = F.lit(0).cast("bigint")
    return (
        totals.join(kept, "source", "left")
        .join(shared, "source", "left")
        .select(
            "source",
            "n_rows",
            (F.col("n_rows") - F.coalesce("kept", zero)).alias("removed"),
            F.coalesce("shared_hashes", zero).alias("shared_hashes"),
        )
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all source outputs; a column missing in one of them is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def except_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def overlap(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that both sides have."""
    return df.select(*keys).distinct().join(other.select(*keys), list(keys), "left_semi")


def greedy_dedupe(
    df: DataFrame,
    partition: Sequence[str],
    order_by: Sequence[Column],
    keys: str,
    limit: int,
    batch: int = 200,
    details: DataFrame | None = None,
    on: str | None = None,
) -> DataFrame:
    """Scan each partition in order; drop a row that shares any key with a kept row.

    Only kept rows mark their keys, and the scan stops at ``limit`` kept rows, so the
    result is neither a grouping nor a window. Each round folds the next ``batch`` rows of
    a partition; of the rows after them, a plain distributed filter removes what shares a
    key with a kept row before the next round. The first row left is always kept, so
    there are at most ``limit`` rounds, and no task ever holds more than ``batch`` rows of
    a partition, whatever its size. What is left is cut off from its lineage before it is
    read again.

    With ``details`` (one row per ``on``) the rows may be narrow: keys and further columns
    are joined to the rows of a round only. Adds ``keep_rank``, the position among the
    kept rows. The order must be total.
    """
    partition = list(partition)
    rest = df.withColumn("_need", F.lit(limit)).withColumn("_done", F.lit(0))
    kept: list[DataFrame] = []
    window = Window.partitionBy(*partition).orderBy(*order_by)
    for _ in range(limit):
        top = rest.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= batch)
        if details is not None:
            top = top.join(details, on)
        columns = [c for c in top.columns if c not in ("_need", "_done", "_rn")]
        rows = F.sort_array(
            F.collect_list(F.struct("_rn", F.col(keys).alias("_keys"), F.struct(*columns).alias("_row")))
        )
        grouped = top.groupBy(*partition, "_need", "_done").agg(rows.alias("_rows"))
        folded = durable(grouped.withColumn("_kept", _fold(F.col("_rows"), F.col("_need"))))
        exploded = folded.select("_done", F.posexplode("_kept").alias("_pos", "_item"))
        kept.append(
            exploded.select(
                "_item._row.*", (F.col("_done") + F.col("_pos") + 1).alias("keep_rank")
            )
        )
        open_parts = folded.filter(
            (F.size("_rows") == batch) & (F.size("_kept") < F.col("_need"))
        ).select(
            *partition,
            (F.col("_need") - F.size("_kept")).alias("_need"),
            (F.col("_done") + F.size("_kept")).alias("_done"),
            F.flatten(F.transform("_kept", lambda r: r["_keys"])).alias("_seen"),
        )
        if open_parts.isEmpty():
            break
        # Rows without keys share none with a kept row, so the position cuts them off.
        left = rest.drop("_need", "_done").join(open_parts, partition)
        left = left.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") > batch).drop("_rn")
        if details is not None:
            left = left.join(details.select(on, F.col(keys).alias("_keys")), on)
        else:
            left = left.withColumn("_keys", F.col(keys))
        rest = durable(left.filter(~F.arrays_overlap("_keys", "_seen")).drop("_seen", "_keys"))
    return reduce(DataFrame.unionByName, kept)


def _fold(rows: Column, need: Column) -> Column:
    """The rows a sequential scan keeps."""
    nothing = F.struct(
        F.filter(rows, lambda r: F.lit(False)).alias("kept"),
        F.array().cast("array<string>").alias("seen"),
    )

    def step(acc: Column, row: Column) -> Column:
        take = (F.size(acc["kept"]) < need) & ~F.arrays_overlap(acc["seen"], row["_keys"])
        return F.when(
            take,
            F.struct(
                F.concat(acc["kept"], F.array(row)).alias("kept"),
                F.concat(acc["seen"], row["_keys"]).alias("seen"),
            ),
        ).otherwise(acc)

    return F.aggregate(rows, nothing, step, lambda acc: acc["kept"])
