"""Curated lists: JSON listings and Markdown tables kept in public repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import classify_experience
from ..functions.dates import parse_datetime, parse_epoch, parse_posted
from ..functions.location import infer_remote, is_non_us
from ..functions.places import joined
from ..functions.regex import let, replace
from ..functions.text import (
    blank_to_null,
    canonical_url,
    extract_cell_text,
    extract_first_url,
    js_trim,
    squash_ws,
)
from ..operators.dedup import dedupe_by
from ..settle import settle
from .canonical import finalize
from .readers import in_document, json_items, markdown_lines, markdown_table

_LISTING = (
    "id: string, title: string, company_name: string, locations: array<string>, url: string, "
    "notes: string, date_posted: bigint, is_visible: boolean, active: boolean"
)


def _listed(payloads: DataFrame, flag: str) -> DataFrame:
    rows = json_items(payloads, _LISTING, [""])
    return rows.filter(F.coalesce(flag, F.lit(True))).transform(settle, 
        {
            "source_id": F.col("id"),
            "company": F.col("company_name"),
            "_first": F.try_element_at("locations", F.lit(1)),
            "posted_at": F.when(F.col("date_posted") != 0, F.timestamp_seconds("date_posted")),
        }
    )


def visible_list(payloads: DataFrame, source: str, level: str) -> DataFrame:
    """``pittcsc`` and ``simplify_internships``: one fixed level, hidden entries dropped."""
    rows = _listed(payloads, "is_visible").transform(settle, 
        {
            "location": F.coalesce("_first", F.lit("")),
            "description": F.col("notes"),
            "experience_level": F.lit(level),
        }
    )
    return finalize(rows.withColumn("remote", infer_remote(F.col("location"))), source)


def active_list(payloads: DataFrame, source: str, as_of: Column, level: str | None = None) -> DataFrame:
    """``vanshb03_*``: inactive entries dropped; without a fixed level only internships
    are told apart from new grads."""
    inferred = classify_experience(F.col("title"))
    choice = F.when(inferred == "internship", "internship").otherwise("new_grad")
    remote = F.exists("locations", lambda p: F.lower(p).contains("remote"))
    rows = _listed(payloads, "active").transform(settle, 
        {
            "location": F.coalesce("_first", F.lit("Remote")),
            "remote": F.coalesce(remote, F.lit(False)),
            "experience_level": choice if level is None else F.lit(level),
            "posted_at": F.coalesce("posted_at", as_of),
        }
    )
    return finalize(rows, source)


def _curated(
    rows: DataFrame,
    source: str,
    posted_at: Column,
    source_id: Column | None = None,
    remote_text: Column | None = None,
    keep: tuple[str, ...] | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """Common rules: required fields, foreign places out, URL once per payload.

    Senior titles count as new grad, unless ``keep`` names the only levels to keep.
    """
    names = ("company", "title", "url")
    rows = rows.transform(settle, {n: js_trim(F.coalesce(n, F.lit(""))) for n in (*names, "location")})
    rows = rows.filter("company <> '' AND title <> '' AND url <> ''")
    rows = rows.filter(~is_non_us(F.col("location")))
    level = classify_experience(F.col("title"))
    if keep is None:
        level = F.coalesce(level, F.lit("new_grad"))
    rows = rows.transform(settle, 
        {
            "experience_level": level,
            "source_id": F.col("url") if source_id is None else F.coalesce(source_id, "url"),
            "remote": infer_remote(F.col("location") if remote_text is None else remote_text),
            "posted_at": posted_at,
        }
    )
    if keep is not None:
        rows = rows.filter(F.col("experience_level").isin(*keep))
    if dedupe:
        key = canonical_url(F.col("url"))
        rows = dedupe_by(
            rows.filter(key != ""), ["run_id", "request_key", "fetch_seq", key], ["ingest_seq"]
        )
    return finalize(rows, source)


_JSON_FORM = (
    "id: string, job_id: string, title: string, job_title: string, company_name: string, "
    "company: string, employer_name: string, locations: array<string>, location: string, "
    "job_city: string, job_state: string, job_country: string, url: string, "
    "job_apply_link: string, job_is_remote: boolean, date_posted: string, "
    "job_posted_at_datetime_utc: string, active: boolean, is_visible: boolean"
)


def curated_json(payloads: DataFrame, source: str) -> DataFrame:
    """Listing files with any of the three naming schemes, epochs in seconds or millis."""
    rows = json_items(payloads, _JSON_FORM, ["", "jobs"])
    rows = rows.filter(F.coalesce("active", F.lit(True)) & F.coalesce("is_visible", F.lit(True)))
    listed = F.filter("locations", lambda p: js_trim(p) != "")
    place = F.coalesce(
        blank_to_null(F.try_element_at(listed, F.lit(1))),
        blank_to_null(F.col("location")),
        joined(F.col("job_city"), F.col("job_state"), F.col("job_country")),
    )
    posted = F.coalesce(
        parse_epoch(F.col("date_posted").try_cast("double")),
        parse_datetime(F.col("date_posted")),
        parse_datetime(F.col("job_posted_at_datetime_utc")),
    )
    rows = rows.transform(settle, 
        {
            "company": F.coalesce("company_name", "company", "employer_name"),
            "title": F.coalesce("title", "job_title"),
            "url": F.coalesce("url", "job_apply_link"),
            "location": place,
            "_remote": F.when(F.coalesce("job_is_remote", F.lit(False)), "Remote").otherwise(place),
        }
    )
    return _curated(rows, source, posted, F.coalesce("id", "job_id"), F.col("_remote"))


def repeated_company_table(payloads: DataFrame, source: str, as_of: Column) -> DataFrame:
    """``jobright_*``: five cells, an arrow repeats the company, links in the title cell."""
    rows = markdown_table(
        payloads, ["company", "title", "location", "model", "posted"], repeat="\u21b3"
    )
    rows = rows.transform(settle, 
        {
            "url": extract_first_url(F.col("title")),
            "company": extract_cell_text(F.col("company")),
            "title": extract_cell_text(F.col("title")),
            "location": extract_cell_text(F.col("location")),
        }
    )
    remote = F.concat_ws(" ", "location", "model")
    return _curated(rows, source, parse_posted(F.col("posted"), as_of), remote_text=remote)


def apply_cell_table(payloads: DataFrame, source: str, as_of: Column) -> DataFrame:
    """``speedyapply_ai_newgrad``: six cells, the link in the fifth."""
    rows = markdown_table(payloads, ["company", "title", "location", "pay", "apply", "posted"])
    return _curated(_cells_to_text(rows), source, parse_posted(F.col("posted"), as_of))


def _cells_to_text(rows: DataFrame) -> DataFrame:
    return rows.transform(settle, 
        {
            "url": extract_first_url(F.col("apply")),
            **{n: extract_cell_text(F.col(n)) for n in ("company", "title", "location")},
        }
    )


def lock_table(payloads: DataFrame, as_of: Column, json_payloads: DataFrame | None = None) -> DataFrame:
    """``ambicuity``: the JSON file of a run, else its five-cell table, in which a lock
    means closed."""
    source = "ambicuity"
    item = (
        "company: string, title: string, location: string, url: string, posted_at: string, "
        "posted_display: string, is_closed: boolean"
    )
    listed = None
    if json_payloads is not None:
        listed = json_items(json_payloads, item, ["jobs"]).filter(~F.coalesce("is_closed", F.lit(False)))
        payloads = payloads.join(listed.select("run_id").distinct(), "run_id", "left_anti")
    rows = markdown_table(payloads, ["company", "title", "location", "posted", "apply"])
    closed = F.col("company").contains("\U0001f512") | F.col("title").contains("\U0001f512")
    url = F.nullif(F.regexp_extract("apply", "\\((https?://[^)]+)\\)", 1), F.lit(""))
    table = _ambicuity(rows.filter(~closed).withColumn("url", url), source, as_of)
    if listed is None:
        return table
    listed = listed.withColumnRenamed("posted_at", "_at").withColumn("posted", F.col("posted_display"))
    first = _ambicuity(listed, source, as_of, parse_datetime(F.col("_at")))
    return first.unionByName(table)


def _ambicuity(rows: DataFrame, source: str, as_of: Column, exact: Column | None = None) -> DataFrame:
    company = squash_ws(F.regexp_replace(F.coalesce("company", F.lit("")), "^[^A-Za-z0-9]+", ""))
    posted = parse_posted(F.col("posted"), as_of, "ago")
    if exact is not None:
        posted = F.coalesce(exact, posted)
    return _curated(rows.withColumn("company", company), source, posted, dedupe=False)


def _position(labels: Column, pattern: str) -> Column:
    """1-based position of the first label that matches; 0 when none does."""
    return F.array_position(F.transform(labels, lambda x: x.rlike(f"(?i)^(?:{pattern})\\z")), True)


def headed_table(payloads: DataFrame, as_of: Column, readme: bool = False) -> DataFrame:
    """``speedyapply_swe_newgrad``: columns by header, inside the new-grad section.

    A README counts from its new-grad heading to the next second-level heading. A table
    header holds until the table ends; without one, five or six cells go by position.
    """
    doc = in_document()
    lines = markdown_lines(payloads.withColumn("body", F.regexp_replace("body", "(?m)^[ \\t]+|[ \\t\\r]+$", "")))
    new_grad = F.col("line").rlike("(?i)^#{1,6}\\s+.*(?<![A-Za-z0-9_])new\\s+(?:grad|graduate)(?![A-Za-z0-9_])")
    if readme:
        lines = lines.withColumn("_seen", F.max(new_grad).over(doc))
        ends = F.col("_seen") & F.col("line").rlike("^##\\s+") & ~new_grad
        lines = lines.withColumn("_over", F.max(ends).over(doc)).filter("_seen AND NOT _over")
    in_table = F.col("line").startswith("|")
    lines = lines.withColumn("_block", F.sum((~in_table).cast("int")).over(doc))
    # Only a line that names both columns can be a header; most lines skip the clean-up.
    likely = F.col("line").rlike("(?i)company") & F.col("line").rlike("(?i)position|title|role")
    labels = F.when(likely, F.transform("cells", extract_cell_text))
    lines = lines.transform(settle, {"_labels": labels})
    labels = F.col("_labels")
    is_header = (_position(labels, "company") > 0) & (_position(labels, "position|title|role") > 0)
    header = F.when(
        is_header,
        F.struct(
            F.col("_block").alias("block"),
            _position(labels, "company").alias("company"),
            _position(labels, "position|title|role").alias("title"),
            _position(labels, "location").alias("location"),
            _position(labels, "posting|apply|application").alias("apply"),
            _position(labels, "age|posted|date").alias("posted"),
        ),
    )
    lines = lines.withColumn("_is_header", F.coalesce(is_header, F.lit(False))).withColumn(
        "_head", F.last(header, ignorenulls=True).over(doc)
    )
    head = F.col("_head")
    headed = F.coalesce(
        (head["block"] == F.col("_block")) & (head["location"] > 0) & (head["apply"] > 0), F.lit(False)
    )
    n = F.size("cells")
    rows = lines.filter(F.col("cells").isNotNull() & ~F.col("_is_header")).filter(headed | n.isin(5, 6))

    def cell(name: str, five: int, six: int) -> Column:
        by_position = F.when(n == 6, six + 1).otherwise(five + 1)
        index = F.when(headed, F.nullif(head[name].cast("int"), F.lit(0))).otherwise(by_position)
        return F.try_element_at("cells", index)

    places = {"company": (0, 0), "title": (1, 1), "location": (2, 2), "apply": (3, 4), "posted": (4, 5)}
    rows = _cells_to_text(rows.transform(settle, {k: cell(k, *v) for k, v in places.items()}))
    return _curated(
        rows.filter("location <> ''"),
        "speedyapply_swe_newgrad",
        parse_posted(F.col("posted"), as_of, "age"),
        keep=("new_grad", "entry_level"),
    )


def last_link_table(payloads: DataFrame, as_of: Column) -> DataFrame:
    """``zapplyjobs``: columns by header, the link in the last cell, once per repository."""
    doc = in_document()
    lines = markdown_lines(payloads.withColumn("body", F.regexp_replace("body", "(?m)^[ \\t]+|[ \\t\\r]+$", "")))
    rows = lines.filter(F.size("cells") >= 4)
    rows = rows.filter(~F.forall("cells", lambda c: c.rlike("^:?-{3,}:?\\z")))
    company = js_trim(F.regexp_replace(extract_cell_text(F.col("cells")[0]), "^[^\\p{L}\\p{N}]+", ""))
    rows = rows.transform(settle, {"company": company}).filter("company <> ''")
    n = F.size("cells")
    heads = F.transform(
        "cells", lambda c: F.trim(F.regexp_replace(F.lower(extract_cell_text(c)), "[^a-z0-9]+", " "))
    )

    def columns(h: Column) -> Column:
        title = _position(h, "role|title|job title")
        place = F.array_position(F.transform(h, lambda x: x.contains("location")), True)
        default = F.least(F.greatest(n - 3, F.lit(2)), n - 2) + 1
        return F.struct(
            F.when(title > 0, title).otherwise(2).cast("int").alias("title"),
            F.when(place > 0, place).otherwise(default).cast("int").alias("location"),
            _position(h, "posted|date posted").cast("int").alias("posted"),
        )

    is_header = F.lower("company") == "company"
    own = let(heads, columns)
    rows = rows.transform(settle, {"_own_head": F.when(is_header, own)})
    rows = rows.withColumn("_head", F.last("_own_head", ignorenulls=True).over(doc))
    rows = rows.filter("_own_head IS NULL")
    # Only rows above the first header have to look at their own cells.
    rows = rows.transform(settle, {"_head": F.coalesce("_head", own)})
    head = F.col("_head")

    def cell(name: str) -> Column:
        return F.coalesce(F.try_element_at("cells", F.nullif(head[name], F.lit(0))), F.lit(""))

    rows = rows.transform(settle, 
        {
            "title": extract_cell_text(cell("title")),
            "location": extract_cell_text(cell("location")),
            "posted": extract_cell_text(cell("posted")),
            "url": extract_first_url(F.element_at("cells", -1)),
        }
    )
    return _curated(rows, "zapplyjobs", parse_posted(F.col("posted"), as_of))


def strip_lead(col: Column) -> Column:
    """Text without leading list marks."""
    return replace(col, "^(?:[-*]\\s*)+", "")
