"""Run summaries and the per-source count audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedupe_by

STATUSES = ["PASS", "WARN", "FAIL", "SKIP"]


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("bigint"))


def run_summary(batch: DataFrame) -> DataFrame:
    """Postings per source; the row with the source ``(total)`` is the grand total."""
    return (
        batch.rollup("source")
        .agg(F.count("*").alias("postings"), F.grouping("source").alias("_g"))
        .select(
            F.when(F.col("_g") == 1, "(total)").otherwise(F.col("source")).alias("source"),
            "postings",
        )
    )


def active_counts(jobs: DataFrame) -> DataFrame:
    return jobs.filter("is_active").groupBy("source").agg(F.count("*").alias("active"))


def audit_counts(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """Status of each expected source, also of those without a single row.

    ``counts(source, postings, failed)``, ``rules(source, baseline, threshold, mode)``.
    PASS needs more postings than the threshold.
    """
    joined = rules.join(counts, "source", "left")
    postings = _zero("postings")
    failed = F.coalesce("failed", F.lit(False))
    return joined.select(
        "source",
        postings.alias("postings"),
        "baseline",
        "threshold",
        F.when(F.col("mode") == "skip", "SKIP")
        .when(failed | (postings == 0), "FAIL")
        .when(postings > F.col("threshold"), "PASS")
        .otherwise("WARN")
        .alias("status"),
    )


def audit_summary(audited: DataFrame) -> DataFrame:
    """One row with the number of sources in each status."""
    return audited.groupBy().agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES]
    )


def count_drift(phase1: DataFrame, phase2: DataFrame, baseline: DataFrame) -> DataFrame:
    """Differences between the check run, the upload run and the baseline.

    All three are ``(source, postings)``.
    """
    one = phase1.select("source", F.col("postings").alias("phase1"))
    two = phase2.select("source", F.col("postings").alias("phase2"))
    base = baseline.select("source", F.col("postings").alias("baseline"))
    joined = one.join(two, "source", "full_outer").join(base, "source", "full_outer")
    return joined.select(
        "source",
        _zero("phase1").alias("phase1"),
        _zero("phase2").alias("phase2"),
        _zero("baseline").alias("baseline"),
        (_zero("phase2") - _zero("phase1")).alias("upload_drift"),
        (_zero("phase1") - _zero("baseline")).alias("baseline_drift"),
    )


def gate_stats(postings: DataFrame, key: str, order_by: list[str], reason: str) -> DataFrame:
    """Distinct postings and rejections per gate; a repeated posting counts once."""
    first = dedupe_by(postings, [key], order_by)
    return first.agg(
        F.count("*").alias("unique_fetched"),
        *[
            F.count_if(F.col(reason) == gate).alias(f"dropped_{gate}")
            for gate in ("level", "senior_title", "non_us", "non_latin", "non_tech", "bad_url")
        ],
        F.count_if(F.col(reason).isNull()).alias("kept"),
    )


def fill_rate(postings: DataFrame) -> DataFrame:
    """Share of postings with a description, per source."""
    filled = F.length(F.trim(F.coalesce("description", F.lit("")))) > 0
    return postings.groupBy("source").agg(
        F.count_if(filled).alias("with_description"),
        F.count("*").alias("postings"),
        F.avg(filled.cast("double")).alias("fill_rate"),
    )


def raw_vs_kept(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Listed, visible and kept entries per source; ``raw(source, is_visible)``."""
    visible = F.coalesce("is_visible", F.lit(True))
    raw_counts = raw.groupBy("source").agg(
        F.count("*").alias("raw"), F.count_if(visible).alias("visible")
    )
    kept_counts = kept.groupBy("source").agg(F.count("*").alias("kept"))
    return raw_counts.join(kept_counts, "source", "left").select(
        "source", "raw", "visible", _zero("kept").alias("kept")
    )


def companies_with_rows(postings: DataFrame) -> DataFrame:
    return postings.groupBy("source").agg(F.count_distinct("company").alias("companies"))
