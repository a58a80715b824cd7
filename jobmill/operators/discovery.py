"""Board discovery: slugs from text, candidate lists, validation and probe results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regex import SPACE_MEMBERS, let
from ..functions.text import humanize_slug, js_trim, squash_ws
from .dedup import dedupe_by, except_known

_URL_CHARS = f"[^{SPACE_MEMBERS}<>\"'`]"

#: order in which discovery buckets are tried
BUCKETS = ["cache", "github", "related", "crawl", "cert_log", "directory"]


def valid_slug(col: Column, charset: str = "a-z0-9._-") -> Column:
    """Decoded, lower-cased slug; null when it cannot name a board."""
    slug = F.lower(js_trim(F.try_url_decode(F.regexp_replace(js_trim(col), "\\+", "%2B"))))
    ok = (
        F.length(slug).between(2, 100)
        & ~slug.rlike("^[0-9]+\\z")
        & slug.rlike(f"^[a-z0-9][{charset}]*\\z")
    )
    return F.when(ok, slug)


def extract_board_slugs(
    text: Column, host: str, place: str = "path", charset: str = "a-z0-9._-", param: str = ""
) -> Column:
    """Distinct slugs of the board links in a text, in order of appearance.

    ``place``: ``path`` (first segment), ``host`` (sub-domain label) or ``query``
    (value of ``param``).
    """
    literal = host.replace(".", "\\.")
    if place == "path":
        pattern = f"(?i)(?<![A-Za-z0-9.-]){literal}/([^/?#)\"'{SPACE_MEMBERS}<>`]+)"
    elif place == "host":
        pattern = f"(?i)([a-z0-9-]+)\\.{literal}(?![A-Za-z0-9_-])"
    elif place == "query":
        pattern = f"(?i){literal}/[^{SPACE_MEMBERS}\"'<>]*[?&]{param}=([^&#{SPACE_MEMBERS}\"'<>]+)"
    else:
        raise ValueError("place must be 'path', 'host' or 'query'")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_distinct(F.array_compact(F.transform(found, lambda s: valid_slug(s, charset))))


def _ai_variant(slug: Column) -> Column:
    return F.when(slug.endswith("-ai"), F.regexp_replace(slug, "-ai\\z", "ai")).when(
        slug.endswith("ai"), F.regexp_replace(slug, "ai\\z", "-ai")
    )


def _valid_distinct(variants: Sequence[Column]) -> Column:
    return F.array_distinct(F.array_compact(F.transform(F.array(*variants), lambda s: valid_slug(s))))


def slug_variants(col: Column) -> Column:
    """Spellings under which a board may be found."""

    def spell(slug: Column) -> Column:
        return _valid_distinct(
            [
                slug,
                F.regexp_replace(slug, "-", ""),
                F.regexp_replace(slug, "\\.", "-"),
                F.regexp_replace(slug, "\\.", ""),
                F.when(slug.contains("."), F.substring_index(slug, ".", 1)),
                _ai_variant(slug),
            ]
        )

    slug = valid_slug(col)
    return F.when(slug.isNotNull(), let(slug, spell)).otherwise(F.array().cast("array<string>"))


def _name_slug(name: Column) -> Column:
    text = F.lower(squash_ws(name))
    text = F.regexp_replace(text, "&", " and ")
    text = F.regexp_replace(text, "[@+]", " ")
    text = F.regexp_replace(text, "['\"]", "")
    text = F.regexp_replace(text, "[^a-z0-9.]+", "-")
    text = F.regexp_replace(text, "^-+|-+\\z", "")
    return valid_slug(F.regexp_replace(text, "-{2,}", "-"))


def name_variants(name: Column) -> Column:
    """Slugs under which a company of this name may run its board."""
    cleaned = squash_ws(F.translate(name, "|()/:", "     "))
    pieces = F.filter(F.transform(F.split(cleaned, "[-,]"), squash_ws), lambda p: F.length(p) >= 2)
    bases = F.array_compact(F.transform(F.concat(F.array(cleaned), pieces), lambda n: _name_slug(n)))

    def spell(base: Column) -> Column:
        return _valid_distinct(
            [
                base,
                F.regexp_replace(base, "-", ""),
                F.regexp_replace(base, "and", ""),
                F.regexp_replace(base, "\\.", "-"),
                F.regexp_replace(base, "\\.", ""),
                _ai_variant(base),
            ]
        )

    return F.array_distinct(F.flatten(F.transform(bases, spell)))


def hostname_variants(host: Column) -> Column:
    """The host without ``www`` and its registered label."""
    clean = F.lower(F.regexp_replace(F.regexp_replace(F.lower(host), "^\\*\\.", ""), "^www\\d*\\.", ""))
    labels = F.filter(F.split(clean, "\\."), lambda p: p != "")
    tld = F.try_element_at(labels, F.lit(-1))
    sld = F.try_element_at(labels, F.lit(-2))
    third = F.try_element_at(labels, F.lit(-3))
    national = (F.length(tld) == 2) & (F.length(sld) <= 3) & third.isNotNull()
    label = F.when(F.size(labels) >= 2, F.when(national, third).otherwise(sld))
    return F.array_distinct(F.array_compact(F.array(F.nullif(clean, F.lit("")), label)))


def slug_candidates(buckets: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """``slug, bucket, bucket_rank``: each slug under its first bucket.

    ``limit`` keeps the first candidates in bucket and slug order.
    """
    frames = [
        buckets[name].select("slug", F.lit(name).alias("bucket"), F.lit(i).alias("bucket_rank"))
        for i, name in enumerate(BUCKETS)
        if name in buckets
    ]
    merged = dedupe_by(reduce(DataFrame.unionByName, frames), ["slug"], ["bucket_rank"])
    if limit is None:
        return merged
    return merged.orderBy("bucket_rank", "slug").limit(limit)


def bucket_coverage(candidates: DataFrame, cached: DataFrame) -> DataFrame:
    """Candidates per bucket, and how many of them the cache does not have."""
    new = except_known(candidates, cached, ["slug"]).groupBy("bucket").agg(F.count("*").alias("new"))
    return (
        candidates.groupBy("bucket")
        .agg(F.count("*").alias("slugs"))
        .join(new, "bucket", "left")
        .select("bucket", "slugs", F.coalesce("new", F.lit(0).cast("bigint")).alias("new"))
    )


def apply_validation(cached: DataFrame, probes: DataFrame) -> DataFrame:
    """Cache changes: ``slug, company_name, job_count, change`` (added, kept, removed).

    ``cached(slug, company_name)``, ``probes(slug, job_count, fetched_name)``. A board
    stays with at least one job; the cached name goes before the fetched one.
    """
    alive = probes.filter(F.col("job_count") >= 1)
    joined = cached.withColumn("_old", F.lit(True)).join(
        alive.withColumn("_alive", F.lit(True)), "slug", "full_outer"
    )
    name = F.coalesce(
        F.nullif("company_name", F.lit("")),
        F.nullif("fetched_name", F.lit("")),
        humanize_slug(F.regexp_replace("slug", "[._-]+", "-")),
    )
    change = (
        F.when(F.col("_alive").isNull(), "removed")
        .when(F.col("_old").isNull(), "added")
        .otherwise("kept")
    )
    return joined.select(
        "slug",
        name.alias("company_name"),
        F.coalesce("job_count", F.lit(0).cast("bigint")).cast("bigint").alias("job_count"),
        change.alias("change"),
    )


def top_additions(changes: DataFrame, n: int = 30) -> DataFrame:
    """The added boards with the most jobs."""
    return changes.filter("change = 'added'").orderBy(F.col("job_count").desc(), "slug").limit(n)


def probe_status(attempts: DataFrame) -> DataFrame:
    """Per company and site: ``verified`` with the first working version, ``timeout``, ``dead``.

    ``attempts(company, site, version, attempt_order, status)``.
    """
    works = F.col("status") == "verified"
    return (
        attempts.groupBy("company", "site")
        .agg(
            F.min_by(F.when(works, F.col("version")), F.when(works, F.col("attempt_order"))).alias("version"),
            F.bool_or(works).alias("_ok"),
            F.bool_or(F.col("status") == "timeout").alias("_slow"),
        )
        .select(
            "company",
            "site",
            F.when(F.col("_ok"), "verified").when(F.col("_slow"), "timeout").otherwise("dead").alias("status"),
            "version",
        )
    )


def crawl_index_rows(payloads: DataFrame) -> DataFrame:
    """``request_key, url`` of JSON-lines bodies; broken lines are skipped."""
    lines = payloads.select("request_key", F.explode(F.split("body", "\n")).alias("line"))
    row = F.from_json("line", "struct<url: string>")
    return lines.select("request_key", row["url"].alias("url")).filter("url IS NOT NULL")
