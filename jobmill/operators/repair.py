"""Repair jobs over stored postings. Each returns the rows to change, not the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import classify_experience, infer_roles, normalize_roles

# Sources that once stored postings without looking at the description.
TEXT_SOURCES = [
    "greenhouse", "lever", "adzuna", "jobspy_indeed", "arbeitnow", "remoteok", "themuse",
]


def reclassify_roles(jobs: DataFrame) -> DataFrame:
    """Postings whose recomputed roles differ, order included; missing roles differ."""
    return (
        jobs.withColumn("new_roles", infer_roles(F.col("title")))
        .filter(~F.col("new_roles").eqNullSafe(F.col("roles")))
        .select("id", "roles", "new_roles")
    )


def reclassify_experience(jobs: DataFrame) -> DataFrame:
    """Active postings to retire because the title alone is senior."""
    senior = classify_experience(F.col("title")).isNull()
    return jobs.filter("is_active").filter(senior).select("id", "source", "title")


def cleanup_senior(jobs: DataFrame, sources: list[str] = TEXT_SOURCES) -> DataFrame:
    """Active postings of the named sources that are senior by title and description."""
    senior = classify_experience(F.col("title"), F.col("description")).isNull()
    chosen = jobs.filter("is_active").filter(F.col("source").isin(sources))
    return chosen.filter(senior).select("id", "source", "title")


def canonicalize_roles(jobs: DataFrame) -> DataFrame:
    """Strictly normalised roles with the outcome per posting.

    ``updated``, ``unchanged`` or ``skipped_unknown``; postings without roles are left out.
    """
    scanned = jobs.filter(F.col("roles").isNotNull()).withColumn(
        "new_roles", normalize_roles(F.col("roles"), strict=True)
    )
    return scanned.select(
        "id",
        "roles",
        "new_roles",
        F.when(F.col("new_roles").isNull(), "skipped_unknown")
        .when(F.col("new_roles") == F.col("roles"), "unchanged")
        .otherwise("updated")
        .alias("outcome"),
    )
