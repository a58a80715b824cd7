"""The filtered, searched and paged feed, and the tracker."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import CURATED_SOURCES, first_rows

# Fixed values of the plans.
PAGE_SIZES = {"free": 20, "pro": 50}
FREE_TRACKED = 100
SOURCE_GROUPS = {"github_repos": CURATED_SOURCES}
APPLICATION_STATUSES = [
    "applied", "phone_screen", "oa", "interview", "offer", "rejected", "withdrawn",
]
#: weights of title, company and description hits (the public defaults A, B, C)
SEARCH_WEIGHTS = {"title": 1.0, "company": 0.4, "description": 0.2}


def usa_or_other(jobs: DataFrame, choice: str) -> DataFrame:
    if choice not in ("usa", "other"):
        raise ValueError("choice must be 'usa' or 'other'")
    return jobs.filter(F.col("is_usa") == F.lit(choice == "usa"))


def job_feed(
    jobs: DataFrame,
    roles: Sequence[str] = (),
    level: str | None = None,
    remote: bool = False,
    sources: Sequence[str] = (),
    posted_after: Column | None = None,
    place: str | None = None,
) -> DataFrame:
    """Active postings that pass every given filter; a source may be a group name."""
    out = jobs.filter("is_active")
    if level:
        out = out.filter(F.col("experience_level") == level)
    if remote:
        out = out.filter("remote")
    if sources:
        names = [s for name in sources for s in SOURCE_GROUPS.get(name, [name])]
        out = out.filter(F.col("source").isin(names))
    if posted_after is not None:
        out = out.filter(F.col("posted_at") > posted_after)
    if place:
        out = usa_or_other(out, place)
    if roles:
        out = out.filter(F.arrays_overlap("roles", F.array(*map(F.lit, roles))))
    return out


def page(df: DataFrame, order_by: Sequence[Column], tier: str, number: int = 1) -> DataFrame:
    """One page. A free plan gets nothing past the first page, see ``needs_upgrade``."""
    size = PAGE_SIZES[tier]
    if needs_upgrade(tier, number):
        return df.limit(0)
    return df.orderBy(*order_by).offset((number - 1) * size).limit(size)


def needs_upgrade(tier: str, number: int) -> bool:
    return tier != "pro" and number > 1


def search_ranked(jobs: DataFrame, query: str) -> DataFrame:
    """Postings that contain every word of the query, with a weighted hit count.

    ``rank`` adds up the hits in title, company and description by field weight. It is a
    per-row expression, so a search is one scan without a shuffle.
    """
    terms = list(dict.fromkeys(w for w in _words(query) if w))
    if not terms:
        return jobs.limit(0).withColumn("rank", F.lit(0.0))
    out = jobs
    for field in SEARCH_WEIGHTS:
        tokens = F.split(F.lower(F.coalesce(field, F.lit(""))), "[^a-z0-9]+")
        out = out.withColumn(f"_{field}", F.filter(tokens, lambda t: t.isin(terms)))
    found = F.concat(*[F.col(f"_{field}") for field in SEARCH_WEIGHTS])
    rank = reduce(
        lambda a, b: a + b, [F.size(f"_{f}") * F.lit(w) for f, w in SEARCH_WEIGHTS.items()]
    )
    return (
        out.filter(F.size(F.array_distinct(found)) == len(terms))
        .withColumn("rank", rank)
        .drop(*[f"_{f}" for f in SEARCH_WEIGHTS])
    )


def _words(query: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split()


def sample_rows(df: DataFrame, rules: Sequence[Column], n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows that pass the first rule any row passes."""
    tier = F.coalesce(*[F.when(rule, F.lit(i)) for i, rule in enumerate(rules)])
    # Rows of a better rule sort first, so n rows hold all of the best rule that count.
    top = df.withColumn("_tier", tier).filter("_tier IS NOT NULL")
    top = top.orderBy("_tier", *order_by).limit(n)
    best = top.agg(F.min("_tier").alias("_best"))
    return top.join(F.broadcast(best), top["_tier"] == best["_best"]).drop("_tier", "_best")


def application_stats(applications: DataFrame) -> DataFrame:
    """Per user: applications, interviews, and the number in each status."""
    return applications.groupBy("user_id").agg(
        F.count("*").alias("applications"),
        F.sum("interview_count").cast("bigint").alias("interviews"),
        *[F.count_if(F.col("status") == s).alias(s) for s in APPLICATION_STATUSES],
    )


def tracker_cap(applications: DataFrame, profiles: DataFrame, cap: int = FREE_TRACKED) -> DataFrame:
    """The tracked postings a user sees: all for pro, the first ``cap`` for free."""
    tiers = profiles.select(F.col("id").alias("user_id"), F.coalesce("tier", F.lit("free")).alias("_tier"))
    joined = applications.join(tiers, "user_id")
    pro = joined.filter(F.col("_tier") == "pro")
    free = joined.filter(F.col("_tier") != "pro")
    kept = first_rows(free, ["user_id"], [F.col("applied_at"), F.col("job_id")], cap)
    return pro.unionByName(kept).drop("_tier")
