"""From mapped fields to the canonical posting: the common tail of all adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (
    classify_experience,
    infer_roles,
    normalize_roles,
    passes_early_career,
)
from ..functions.dates import parse_datetime
from ..functions.keys import posting_hash
from ..functions.location import infer_remote, is_non_us, is_usa
from ..functions.text import blank_to_null
from ..settle import settle

_OPTIONAL = {
    "source_id": "string",
    "location": "string",
    "description": "string",
    "salary_min": "int",
    "salary_max": "int",
    "posted_at": "timestamp",
}

_COLUMNS = [
    "source", "source_id", "title", "company", "location", "remote", "is_usa", "url",
    "description", "salary_min", "salary_max", "experience_level", "roles", "posted_at",
    "dedup_hash", "ingest_seq",
]


def finalize(df: DataFrame, source: str | Column) -> DataFrame:
    """Complete mapped rows: missing optional columns, roles, country flag and hash.

    Rows without a level are senior and go. ``df`` has title, company, url, remote,
    experience_level and ingest_seq; ``roles`` and ``dedup_hash`` are derived from the
    row unless an adapter has set them.
    """
    out = df.withColumn("source", F.lit(source) if isinstance(source, str) else source)
    out = out.filter(F.col("experience_level").isNotNull())
    have = set(out.columns)
    extra = {n: F.lit(None).cast(t) for n, t in _OPTIONAL.items() if n not in have}
    if "roles" not in have:
        extra["roles"] = infer_roles(F.col("title"))
    out = out.transform(settle, extra) if extra else out
    tail = {
        "remote": F.coalesce("remote", F.lit(False)),
        "is_usa": is_usa(F.col("location"), F.col("remote")),
    }
    if "dedup_hash" not in have:
        tail["dedup_hash"] = posting_hash(F.col("company"), F.col("title"), F.col("location"))
    return out.transform(settle, tail).select(*_COLUMNS)


def normalize_posting(df: DataFrame, source: str | Column) -> DataFrame:
    """Shared strict normaliser for listings enriched with a detail page.

    Needs title, company, url; optional location, description, remote, posted_text,
    roles, role_text, experience_text, source_id. Gates: required fields, foreign
    locations, the early-career check, the level.
    """
    have = set(df.columns)

    def text(name: str) -> Column:
        return blank_to_null(F.col(name)) if name in have else F.lit(None).cast("string")

    fields = {n: text(n) for n in ("title", "company", "url", "location", "description", "source_id")}
    fields["_posted"] = text("posted_text")
    fields["_content"] = F.coalesce(
        F.col("experience_text") if "experience_text" in have else F.lit(None).cast("string"),
        text("description"),
    )
    fields["_remote"] = F.coalesce(F.col("remote"), F.lit(False)) if "remote" in have else F.lit(False)
    fields["_role_text"] = F.coalesce(
        F.col("role_text") if "role_text" in have else F.lit(None).cast("string"), text("title")
    )
    no_roles = F.array().cast("array<string>")
    fields["_given"] = F.coalesce("roles", no_roles) if "roles" in have else no_roles
    out = df.transform(settle, fields).withColumn("remote", F.col("_remote") | infer_remote(F.col("location")))
    out = out.filter("title IS NOT NULL AND company IS NOT NULL AND url IS NOT NULL")
    foreign = is_non_us(F.col("location")) & ~is_usa(F.col("location"), F.col("remote"))
    out = out.filter(~foreign).filter(passes_early_career(F.col("title"), F.col("_content")))
    out = out.transform(settle, 
        {
            "experience_level": classify_experience(F.col("title"), F.col("_content")),
            "roles": F.when(F.size("_given") > 0, normalize_roles(F.col("_given"))).otherwise(
                infer_roles(F.col("_role_text"))
            ),
            "posted_at": parse_datetime(F.col("_posted")),
        }
    )
    return finalize(out, source)
