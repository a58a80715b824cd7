"""Landed payloads as a stream: each finished run is merged into a bucketed snapshot."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedupe_across_sources
from ..operators.merge import merge_snapshot
from ..schema import JOB, RAW_PAYLOAD
from ..session import durable
from ..sources.readers import run_order

Adapter = Callable[[DataFrame], DataFrame]

#: content type of the row that a run lands last, after all its payloads
RUN_END = "run/end"
BUCKETS = 64
ARRIVALS = "run_id string, file string, batch bigint, landed timestamp, payloads bigint, ends boolean"
MANIFEST = "version bigint, run_id string, bucket int, held_by bigint"


def _manifests(spark: SparkSession, store: str) -> DataFrame | None:
    """The manifest rows of all versions; each version names the run that it merged."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{store}/manifest/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _manifest(spark: SparkSession, store: str) -> tuple[int, dict[int, int]]:
    """Newest version, and the version that has each bucket."""
    rows = _manifests(spark, store)
    newest = None if rows is None else rows.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, {}
    last = rows.filter(F.col("version") == newest).collect()  # a row per bucket
    held = {r["bucket"]: r["held_by"] for r in last if r["bucket"] is not None}
    return newest, held


def _is_merged(spark: SparkSession, store: str, run_id: str) -> bool:
    rows = _manifests(spark, store)
    return rows is not None and not rows.filter(F.col("run_id") == run_id).isEmpty()


def _read(spark: SparkSession, store: str, held: dict[int, int]) -> DataFrame:
    paths = [f"{store}/data/version={v:010d}/bucket={b}" for b, v in sorted(held.items())]
    if not paths:
        return spark.createDataFrame([], JOB)
    return spark.read.schema(JOB).parquet(*paths)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("dedup_hash"), F.lit(buckets)).cast("int")


def merge_run(
    spark: SparkSession,
    store: str,
    run_id: str,
    postings: DataFrame,
    scraped_at: Column,
    buckets: int = BUCKETS,
) -> None:
    """Merge the postings of a whole run; only the buckets it touches are rewritten.

    The manifest row of the new version is written last, so a merge that died half-way
    is simply done again. A run is merged once: the manifests of all versions together
    name every merged run, so they have to stay when old buckets are removed.
    """
    if _is_merged(spark, store, run_id):
        return
    version, held = _manifest(spark, store)
    postings = durable(dedupe_across_sources(postings))
    touched = {r["b"] for r in postings.select(_bucket(buckets).alias("b")).distinct().collect()}
    current = _read(spark, store, {b: v for b, v in held.items() if b in touched})
    merged = merge_snapshot(current, postings, scraped_at).withColumn("bucket", _bucket(buckets))
    new = version + 1
    if touched:
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{store}/data/version={new:010d}"
        )
    rows = [(new, run_id, b, v) for b, v in (held | dict.fromkeys(touched, new)).items()]
    rows = rows or [(new, run_id, None, None)]
    manifest = spark.createDataFrame(rows, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{store}/manifest/version={new:010d}")


def incremental_merge(
    spark: SparkSession,
    landing: str,
    store: str,
    adapter: Adapter,
    checkpoint: str,
    scraped_at: Column,
    files_per_batch: int = 1000,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Merge runs into the snapshot as they finish.

    A run's payloads may land in any number of files and micro-batches; what counts is
    its ``RUN_END`` row, which lands last. Then ``adapter`` turns all payloads of the run
    into canonical postings with a ``source_rank``, so duplicates across sources, owners
    and dates do not depend on how files fell into micro-batches. Retirement needs the
    whole run as well and stays a batch step. Runs are merged in the order in which their
    closing rows landed, by the time of the file, which is also the order of micro-batches.
    Closing rows of one file go by the numbers in their ids.

    Each micro-batch notes which files hold rows of which run (``arrivals`` in the store, a
    folder per run), and a finished run reads these files only, however much has landed. A
    payload that comes in a later micro-batch than its closing row is not merged:
    ``late_payloads`` names it, and it can be landed again under a new run. A run without a
    closing row is never merged; ``open_runs`` names it.

    Old versions of a bucket stay readable until they are removed from outside.
    """
    payloads = (
        spark.readStream.schema(RAW_PAYLOAD)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .select(
            "run_id",
            (F.col("content_type") == RUN_END).alias("end"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("landed"),
        )
    )

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        arrived = durable(_arrived(batch, number))
        # A batch that is done again notes the same rows again, which changes nothing.
        by_run = arrived.withColumn("run", F.sha1("run_id")).repartition("run")
        by_run.write.mode("append").partitionBy("run").parquet(f"{store}/arrivals")
        ended = arrived.filter("ends").groupBy("run_id").agg(F.min("landed").alias("landed"))
        for row in ended.orderBy("landed", run_order(F.col("run_id")), "run_id").collect():
            whole = run_payloads(session, store, row["run_id"])
            merge_run(session, store, row["run_id"], adapter(whole), scraped_at, buckets)

    return (
        payloads.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _arrived(batch: DataFrame, number: int) -> DataFrame:
    """Which files of a micro-batch hold rows of which run; rows without a run are left out."""
    end = F.coalesce("end", F.lit(False))
    found = batch.filter("run_id IS NOT NULL").groupBy("run_id", "file").agg(
        F.min("landed").alias("landed"), F.count_if(~end).alias("payloads"), F.bool_or(end).alias("ends")
    )
    return found.select("run_id", "file", F.lit(number).cast("bigint").alias("batch"), "landed", "payloads", "ends")


def run_payloads(spark: SparkSession, store: str, run_id: str) -> DataFrame:
    """The payloads of one run, from the files that hold any."""
    folder = hashlib.sha1(run_id.encode()).hexdigest()
    noted = spark.read.schema(ARRIVALS).parquet(f"{store}/arrivals/run={folder}")
    files = noted.filter("payloads > 0").select("file").distinct().collect()
    if not files:
        return spark.createDataFrame([], RAW_PAYLOAD)
    # Spark names files as URLs, and takes plain paths.
    rows = spark.read.schema(RAW_PAYLOAD).parquet(*[unquote(r["file"]) for r in files])
    end = F.coalesce(F.col("content_type") == RUN_END, F.lit(False))
    return rows.filter((F.col("run_id") == run_id) & ~end)


def _noted(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(f"{ARRIVALS}, run string").parquet(f"{store}/arrivals").drop("run").distinct()


def late_payloads(spark: SparkSession, store: str) -> DataFrame:
    """run_id, file, payloads: what came in a later micro-batch than its run's closing row."""
    noted = _noted(spark, store)
    closed = noted.filter("ends").groupBy("run_id").agg(F.min("batch").alias("closed"))
    late = noted.filter("payloads > 0").join(closed, "run_id").filter("batch > closed")
    return late.select("run_id", "file", "payloads")


def open_runs(spark: SparkSession, store: str) -> DataFrame:
    """run_id, files, payloads, newest: runs whose closing row has not landed."""
    runs = _noted(spark, store).groupBy("run_id").agg(
        F.count_if(F.col("payloads") > 0).alias("files"),
        F.sum("payloads").alias("payloads"),
        F.max("landed").alias("newest"),
        F.bool_or("ends").alias("ended"),
    )
    return runs.filter("NOT ended").drop("ended")


def run_end(spark: SparkSession, run_id: str) -> DataFrame:
    """The row that closes a run."""
    return spark.createDataFrame([(None, run_id, 0, None, None, RUN_END, None)], RAW_PAYLOAD)


def read_snapshot(spark: SparkSession, store: str) -> DataFrame:
    """The newest snapshot."""
    return _read(spark, store, _manifest(spark, store)[1])
