"""A whole run: landed payloads of all sources to a new snapshot with retired postings.

1. The adapters of all sources form one plan, a union. The landing table is partitioned by
   source, so each branch reads its own files and every payload is read once. Counters
   (payloads, failed payloads, postings, postings with a description) are observed in the
   pass that writes the postings.
2. A list entry stays with the first list that has its URL. What is left is written, again
   with counters per source.
3. The batch is merged into the current jobs, the guards decide per source, and the stale
   postings of sources to retire become inactive in the pass that writes the snapshot.

The steps hand on Parquet tables below ``out``, a new folder for each run, so a lost
executor costs its tasks only, and nothing is parsed or merged twice. A source takes part
with success if at least one of its payloads came well; one without any payload, or with
failed ones only, is reported as failed and retires nothing. A source that comes well but
empty is left alone as well (``skip_empty``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.audit import audit_counts
from .operators.dedup import dedupe_across_sources, union_all
from .operators.merge import PARTIAL_SOURCES, merge_snapshot, retire, retirement_guards
from .schema import RAW_PAYLOAD
from .session import durable
from .sources.registry import Landed, Source, chosen
from .sources.store import read_snapshot, write_snapshot

REPORT = (
    "source string, source_rank int, success boolean, payloads bigint, failed_payloads bigint, "
    "fetched bigint, with_description bigint, kept bigint, fresh bigint, active bigint, "
    "stale bigint, decision string, retired bigint"
)


class Run(NamedTuple):
    """A run's results: the new job table, one row per source, and totals of the snapshot."""

    jobs: DataFrame
    report: DataFrame
    totals: dict[str, int]


def land(payloads: DataFrame, path: str) -> None:
    """Append payloads to a landing table, one folder per run and source."""
    payloads.write.mode("append").partitionBy("run_id", "source").parquet(path)


def landed_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The payloads of a run; only its folders are read."""
    return spark.read.schema(RAW_PAYLOAD).parquet(path).filter(F.col("run_id") == run_id)


def _per_source(sources: Sequence[Source], of: Column) -> list[Column]:
    """A counter for each source; there are as many as sources in the registry."""
    return [F.count_if(of & (F.col("run_source") == s.name)).alias(s.name) for s in sources]


_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_PROPAGATE = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@contextmanager
def _counted(spark: SparkSession) -> Iterator[None]:
    """Counters stay in the plan although what they counted turns out to lead to no rows.

    Adaptive execution replaces such a branch by an empty relation, counters included.
    """
    before = spark.conf.get(_EXCLUDED, "")
    spark.conf.set(_EXCLUDED, ",".join(filter(None, [before, _PROPAGATE])))
    try:
        yield
    finally:
        if before:
            spark.conf.set(_EXCLUDED, before)
        else:
            spark.conf.unset(_EXCLUDED)


def _fetched(sources: Sequence[Source], landed: Mapping[str, Landed], path: str) -> tuple[DataFrame, dict[str, dict]]:
    """All postings of all adapters as one written table, and what was counted on the way."""
    spark = next(iter(landed.values())).landing.sparkSession
    parts, found = [], {}
    filled = F.length(F.trim(F.coalesce("description", F.lit("")))) > 0
    for rank, source in enumerate(sources):
        rows = source.adapter(landed[source.name])
        rows = rows.withColumns({"run_source": F.lit(source.name), "source_rank": F.lit(rank)})
        found[source.name] = Observation(f"postings of {source.name}")
        parts.append(rows.observe(
            found[source.name], F.count(F.lit(1)).alias("fetched"), F.count_if(filled).alias("with_description")
        ))
    whole = union_all(parts)
    with _counted(spark):
        whole.write.partitionBy("run_source").parquet(path)
    counts = {}
    for source in sources:
        own = [c.get for c in landed[source.name].counters.values()]
        counts[source.name] = found[source.name].get | {
            "payloads": sum(c["payloads"] for c in own), "failed": sum(c["failed"] for c in own)
        }
    return spark.read.schema(whole.schema).parquet(path), counts


def run_all_sources(
    landing: DataFrame,
    current: DataFrame,
    out: str,
    scraped_at: Column,
    as_of: Column | None = None,
    names: Sequence[str] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    skip_slow: bool = False,
    partial_sources: Sequence[str] = PARTIAL_SOURCES,
    salt: int = 8,
) -> Run:
    """Run all sources, or those named, over the landed payloads of one run.

    ``landing`` has the columns of ``RAW_PAYLOAD``, ``current`` is the job table before the
    run, ``out`` a folder that all executors share and that does not exist. ``tables`` has
    lookup tables by source.
    """
    spark, sources = landing.sparkSession, chosen(names, skip_slow)
    if not sources:
        raise ValueError("no source to run")
    when = scraped_at if as_of is None else as_of
    landed = {s.name: Landed(landing, s.name, when, tables or {}) for s in sources}
    fetched, counts = _fetched(sources, landed, f"{out}/fetched")

    kept = Observation("kept")
    batch = dedupe_across_sources(fetched).observe(kept, *_per_source(sources, F.lit(True)))
    with _counted(spark):
        batch.write.parquet(f"{out}/batch")
    batch = spark.read.schema(fetched.schema).parquet(f"{out}/batch")

    ranked = batch.drop("run_source")
    merged = merge_snapshot(current, ranked, scraped_at)
    merged.write.parquet(f"{out}/merged")
    merged = spark.read.schema(current.schema).parquet(f"{out}/merged")
    came = {s.name: counts[s.name]["payloads"] > counts[s.name]["failed"] for s in sources}
    status = spark.createDataFrame(list(came.items()), "source string, success boolean")
    decisions = durable(retirement_guards(merged, ranked, status, partial_sources))

    totals = Observation("snapshot")
    jobs = retire(merged, ranked, decisions)
    active = F.count_if("is_active").alias("active")
    with _counted(spark):
        write_snapshot(jobs.observe(totals, F.count(F.lit(1)).alias("jobs"), active), f"{out}/jobs", salt)

    rows = []
    by_source = {r["source"]: r for r in decisions.collect()}  # one row per source
    for rank, source in enumerate(sources):
        own, decided = counts[source.name], by_source[source.name]
        rows.append((
            source.name, rank, came[source.name], own["payloads"], own["failed"], own["fetched"],
            own["with_description"], kept.get[source.name], decided["fresh"], decided["active"], decided["stale"],
            decided["decision"], decided["stale"] if decided["decision"] == "retire" else 0,
        ))
    report = spark.createDataFrame(rows, REPORT)
    columns = [F.col(c) for c in current.columns]
    return Run(read_snapshot(spark, f"{out}/jobs").select(*columns), report, dict(totals.get))


def audited(report: DataFrame, rules: DataFrame) -> DataFrame:
    """The status of every expected source after a run (see ``audit_counts``)."""
    counts = report.select("source", F.col("kept").alias("postings"), (~F.col("success")).alias("failed"))
    return audit_counts(counts, rules)
