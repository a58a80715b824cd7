"""Snapshot merge and guarded retirement. Tables in, tables out; nothing is updated in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import js_trim
from .dedup import dedupe_by, dedupe_in_source

#: sources whose runs never retire postings, because a run covers only part of them
PARTIAL_SOURCES = ("jobspy",)


def _writes(batch: DataFrame) -> DataFrame:
    """One row per hash: what the sources of a run, in rank order, write to it."""
    rows = dedupe_in_source(batch)
    # Sources without a rank come first, sources of one rank in the order of their names.
    place = F.struct(F.coalesce("source_rank", F.lit(-1)).alias("rank"), F.col("source").alias("name"))
    columns = [c for c in batch.columns if c not in ("dedup_hash", "source_rank")]
    return rows.groupBy("dedup_hash").agg(
        F.count("*").alias("_writes"),
        F.min_by("source", place).alias("_first_source"),
        F.max("posted_at").alias("_newest"),
        F.max_by(F.struct(*columns), place).alias("_last"),
    )


def merge_snapshot(current: DataFrame, batch: DataFrame, scraped_at: Column) -> DataFrame:
    """The job table after a run has been written to it, source by source.

    The last source of a run owns a posting; its id stays. ``posted_at`` only moves
    forward across sources, but a source that already owns the posting overwrites it.
    New postings get an id derived from their hash.
    """
    writes = _writes(batch)
    joined = current.alias("c").join(writes.alias("w"), "dedup_hash", "full_outer")
    written = F.col("_writes").isNotNull()
    same_owner = F.coalesce(F.col("c.source") == F.col("_first_source"), F.lit(False))
    posted = F.when(same_owner, F.col("_newest")).otherwise(
        F.greatest(F.col("c.posted_at"), F.col("_newest"))
    )
    batch_columns = set(batch.columns)

    def merged(name: str) -> Column:
        old = F.col(f"c.{name}")
        if name == "dedup_hash":
            return F.col("dedup_hash")
        if name == "id":
            return F.coalesce(old, F.md5("dedup_hash")).alias(name)
        if name == "is_active":
            return F.when(written, F.lit(True)).otherwise(old).alias(name)
        if name == "scraped_at":
            return F.coalesce(old, scraped_at).alias(name)
        if name == "posted_at":
            return F.when(written, posted).otherwise(old).alias(name)
        if name in batch_columns:
            return F.when(written, F.col(f"_last.{name}")).otherwise(old).alias(name)
        return old.alias(name)

    return joined.select(*[merged(c) for c in current.columns])


def merge_stats(current: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: rows written, new postings, updates, writes to another source's posting."""
    writes = _writes(batch)
    joined = writes.join(
        current.select("dedup_hash", F.col("source").alias("_owner")), "dedup_hash", "left"
    )
    known = F.col("_owner").isNotNull()
    own = (F.col("_owner") == F.col("_first_source")).cast("int")
    conflicts = F.col("_writes") - F.when(known, own).otherwise(1)
    updates = F.col("_writes") - F.when(known, 0).otherwise(1)
    return joined.agg(
        F.coalesce(F.sum("_writes"), F.lit(0)).alias("attempted"),
        F.count_if(~known).alias("inserted"),
        F.coalesce(F.sum(updates), F.lit(0)).alias("updated"),
        F.coalesce(F.sum("_writes"), F.lit(0)).alias("upserted"),
        F.coalesce(F.sum(conflicts), F.lit(0)).alias("conflicts"),
    )


def _run_hash(col: str) -> Column:
    return F.lower(js_trim(F.col(col)))


def _fresh(batch: DataFrame) -> DataFrame:
    return (
        batch.select("source", _run_hash("dedup_hash").alias("run_hash"))
        .filter(F.col("run_hash") != "")
        .distinct()
    )


def stale_candidates(merged: DataFrame, batch: DataFrame) -> DataFrame:
    """Active postings whose source did not deliver their hash in this run."""
    active = merged.filter("is_active").withColumn("run_hash", _run_hash("dedup_hash"))
    return active.join(_fresh(batch), ["source", "run_hash"], "left_anti").drop("run_hash")


# Fixed values of the guards.
GUARD_MIN_ACTIVE = 100
GUARD_MIN_FRESH = 0.5
GUARD_MAX_STALE = 0.8


def retirement_guards(
    merged: DataFrame,
    batch: DataFrame,
    run_status: DataFrame,
    partial_sources: Sequence[str] = PARTIAL_SOURCES,
) -> DataFrame:
    """Per source of the run: counts and a decision.

    ``run_status(source, success)`` lists every source of the run. ``active`` is counted
    after the merge. Decisions, in order: ``not_considered``, ``skip_empty``,
    ``skip_low_fresh``, ``skip_high_stale``, ``skip_inconsistent``, ``nothing_stale``,
    ``retire``.
    """
    active = merged.filter("is_active").groupBy("source").agg(F.count("*").alias("active"))
    fresh = _fresh(batch).groupBy("source").agg(F.count("*").alias("fresh"))
    stale = (
        stale_candidates(merged, batch)
        .groupBy("source")
        .agg(F.count_distinct("dedup_hash").alias("stale"))
    )
    zero = F.lit(0).cast("bigint")
    counted = (
        run_status.join(active, "source", "left")
        .join(fresh, "source", "left")
        .join(stale, "source", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("active", "fresh", "stale")})
    )
    considered = F.col("success") & ~F.col("source").isin(list(partial_sources))
    return counted.select(
        "source",
        "active",
        "fresh",
        "stale",
        F.when(~considered, "not_considered")
        .when(F.col("fresh") == 0, "skip_empty")
        .when(
            (F.col("active") > GUARD_MIN_ACTIVE)
            & (F.col("fresh") < F.col("active") * GUARD_MIN_FRESH),
            "skip_low_fresh",
        )
        .when(
            (F.col("active") > 0) & (F.col("stale") > F.col("active") * GUARD_MAX_STALE),
            "skip_high_stale",
        )
        .when(
            (F.col("stale") == 0) & (F.col("active") > F.col("fresh")), "skip_inconsistent"
        )
        .when(F.col("stale") == 0, "nothing_stale")
        .otherwise("retire")
        .alias("decision"),
    )


def retire(merged: DataFrame, batch: DataFrame, decisions: DataFrame) -> DataFrame:
    """Mark the stale postings of the sources to retire as inactive.

    The decision list has one row per source, so it is broadcast: a shuffle by source
    would put the largest source into one task.
    """
    chosen = decisions.filter("decision = 'retire'").select("source", F.lit(True).alias("_retire"))
    fresh = _fresh(batch).withColumn("_fresh", F.lit(True))
    marked = (
        merged.withColumn("run_hash", _run_hash("dedup_hash"))
        .join(F.broadcast(chosen), "source", "left")
        .join(fresh, ["source", "run_hash"], "left")
    )
    stale = F.col("_retire").isNotNull() & F.col("_fresh").isNull()
    return marked.withColumn("is_active", F.col("is_active") & ~stale).select(*merged.columns)


def insert_ignore(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The table plus the rows whose key it does not have yet, each key once.

    The first row of a key counts, in ``order_by`` and then in the order of all columns.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in order_by]
    new = first_write(rows, keys, [*order_by, *rest]).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(new, allowMissingColumns=True)


#: runs a company is left out after it answered with errors only
SKIP_RUNS = 3


def split_probe_run(state: DataFrame) -> DataFrame:
    """The state at the start of a run: companies to skip count down by one."""
    skip = F.coalesce("zero_count", F.lit(0)) > 0
    return state.withColumn("skipped", skip).withColumn(
        "zero_count", F.when(skip, F.col("zero_count") - 1).otherwise(F.col("zero_count"))
    )


def update_probe_state(state: DataFrame, results: DataFrame, run_date: Column) -> DataFrame:
    """The probe table after a run.

    ``state``    company, zero_count, last_attempt, wd_version, slug, known_targets
    ``results``  company, jobs, raw_jobs, had_timeout, had_success, had_error,
                 wd_version, slug (last target that worked), known_targets (all of them)
    Companies the run skipped have no result row. Entries that say nothing are dropped.
    """
    begun = split_probe_run(state).drop("skipped")
    joined = begun.alias("s").join(results.alias("r"), "company", "full_outer")
    tried = F.col("r.jobs").isNotNull()
    only_errors = (
        (F.col("r.jobs") == 0)
        & ~F.col("r.had_timeout")
        & (F.col("r.raw_jobs") == 0)
        & F.col("r.had_error")
        & ~F.col("r.had_success")
    )
    empty = F.create_map().cast("map<string,struct<wd_version:string,slug:string>>")
    old = F.coalesce(F.col("s.known_targets"), empty)
    new = F.coalesce(F.col("r.known_targets"), empty)
    unchanged = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    merged = joined.select(
        "company",
        F.when(tried, F.when(only_errors, SKIP_RUNS).otherwise(0))
        .otherwise(F.coalesce("s.zero_count", F.lit(0)))
        .alias("zero_count"),
        F.when(tried, run_date).otherwise(F.col("s.last_attempt")).alias("last_attempt"),
        F.coalesce("r.wd_version", "s.wd_version").alias("wd_version"),
        F.coalesce("r.slug", "s.slug").alias("slug"),
        F.map_concat(unchanged, new).alias("known_targets"),
    )
    return merged.filter(
        (F.col("zero_count") > 0)
        | (F.size("known_targets") > 0)
        | (F.col("wd_version").isNotNull() & F.col("slug").isNotNull())
    )


def score_jobs(scores: DataFrame, jobs: DataFrame) -> DataFrame:
    """Scores with their postings: active, in the United States, graded A to C."""
    wanted = jobs.filter("is_active AND is_usa").withColumnRenamed("id", "job_id")
    return scores.filter(F.col("grade").isin("A", "B", "C")).join(wanted, "job_id")


def exclude_seen(matches: DataFrame, applied: DataFrame, sent: DataFrame) -> DataFrame:
    """Matches without the postings a user has applied to or was already sent."""
    seen = applied.select("user_id", "job_id").unionByName(sent.select("user_id", "job_id"))
    return matches.join(seen, ["user_id", "job_id"], "left_anti")


def first_write(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row of each key, for tables that ignore later inserts."""
    return dedupe_by(rows, keys, order_by, keep="first")
