"""Identity keys of postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import let
from .text import dedupe_text, dedupe_url, js_trim, root_words


def posting_hash(company: Column, title: Column, location: Column) -> Column:
    """md5 of the lower-cased, trimmed parts; a missing part counts as empty."""

    def part(col: Column) -> Column:
        return js_trim(F.lower(F.coalesce(col, F.lit(""))))

    joined = F.concat(part(company), F.lit("|"), part(title), F.lit("|"), part(location))
    return F.md5(joined)


def match_keys(
    id: Column, url: Column, title: Column, company: Column, description: Column
) -> Column:
    """Up to five keys; two postings that share any of them count as the same one."""
    empty = F.lit("")
    parts = F.struct(
        dedupe_text(F.coalesce(title, empty)).alias("title"),
        dedupe_text(F.coalesce(company, empty)).alias("company"),
        F.substring(dedupe_text(F.coalesce(description, empty)), 1, 500).alias("text"),
    )

    def keys(p: Column) -> Column:
        def pair(label: str, other: Column) -> Column:
            value = F.concat(F.lit(f"{label}:"), p["title"], F.lit("|"), other)
            return F.when((p["title"] != "") & (other != ""), value)

        return F.array_compact(
            F.array(
                F.concat(F.lit("id:"), id),
                F.concat(F.lit("url:"), dedupe_url(url)),
                pair("title-company", p["company"]),
                let(root_words(p["company"]), lambda r: pair("title-company-root", r)),
                pair("title-description", p["text"]),
            )
        )

    # Bound once: three of the five keys use the title.
    return let(parts, keys)
