"""Free-text hiring comments to postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import has_tech_signal, level_of, says_new_grad, says_rescue
from ..functions.location import is_non_us
from ..functions.regex import ecma, has_pattern, let, replace
from ..functions.text import first_of_all_urls, js_trim, squash_ws, strip_html
from ..operators.dedup import dedupe_by
from ..settle import settle
from .canonical import finalize
from .lists import strip_lead
from .readers import json_items

# Fixed values of the comment rules.
DESCRIPTION_CHARS = 3000
TITLE_WORDS = 12
EARLY_CAREER = r"\b(?:new grad|entry level|entry-level|junior|0\s*(?:-|to)\s*2 years?)\b"
EMPLOYMENT = r"\b(?:full[-\s]?time|part[-\s]?time|contract|intern(?:ship)?|temporary)\b"
WEBSITE = r"^(?:https?://|www\.|[a-z0-9.-]+\.[a-z]{2,})(?:/[^\s]*)?$"
NO_TITLE = (
    r"^(?:we(?:'re| are)|you(?:'ll| will)|join us|our mission|about\b|please\b|more info\b"
    r"|see more\b|would love\b|reach out\b|apply here\b|apply now\b|come be\b|why\b)"
)
LEADS = ["we are hiring for:?", "hiring for:?", "open roles?:?", "roles?:?", "positions?:?"]
ITEM_URL = "https://news.ycombinator.com/item?id="


def clean_line(col: Column) -> Column:
    return js_trim(strip_lead(squash_ws(col)))


def clean_candidate(col: Column) -> Column:
    """A header segment or line without bullets, lead-ins, trailing links and marks."""
    return let(let(clean_line(col), _without_lead), _without_tail)


def _without_lead(text: Column) -> Column:
    # A text that starts with none of the lead-ins loses none of them.
    cut = text
    for lead in LEADS:
        cut = replace(cut, f"(?i)^{lead}", "")
    any_lead = "|".join(LEADS)
    return F.when(text.rlike(f"(?i)^(?:{any_lead})"), js_trim(cut)).otherwise(text)


def _without_tail(text: Column) -> Column:
    cut = replace(text, r"(?i)\s+(?:\||-)\s+https?://.*$", "")
    cut = replace(cut, r"(?i)\s+https?://.*$", "")
    linked = F.when(text.rlike("(?i)http"), cut).otherwise(text)
    return js_trim(replace(linked, r"\s+[|:-]\s*$", ""))


def _website(col: Column) -> Column:
    return has_pattern(js_trim(col), [WEBSITE])


def _employment(col: Column) -> Column:
    return has_pattern(col, [EMPLOYMENT]) & ~has_tech_signal(col)


def _short(col: Column) -> Column:
    return F.size(F.split(col, ecma(r"\s+"))) <= TITLE_WORDS


def _line_title(line: Column) -> Column:
    """The title a line announces: the part before a colon, or the whole short line."""

    def announced(text: Column) -> Column:
        return let(
            clean_candidate(F.substring_index(text, ":", 1)),
            lambda before: F.when(
                (before != "") & (before != text) & has_tech_signal(before) & _short(before), before
            ).when(has_tech_signal(text) & _short(text) & ~_website(text) & ~_employment(text), text),
        )

    def choose(text: Column) -> Column:
        return F.when((text != "") & ~has_pattern(text, [NO_TITLE]), announced(text))

    return let(clean_candidate(line), choose)


def comment_thread(payloads: DataFrame) -> DataFrame:
    """``hackernews``: ``Company | Title | Location`` headers and titles in later lines.

    The first title whose level is not senior counts. The last comment per hash wins.
    """
    item = "id: bigint, text: string, time: bigint, dead: boolean, deleted: boolean"
    rows = json_items(payloads, item, ["", "items"])
    gone = F.coalesce("dead", F.lit(False)) | F.coalesce("deleted", F.lit(False))
    rows = rows.filter(F.col("id").isNotNull() & (F.coalesce("text", F.lit("")) != "") & ~gone)
    text = F.substring(strip_html(F.col("text"), "comment"), 1, DESCRIPTION_CHARS)
    rows = rows.transform(settle, {"description": text})
    lines = F.filter(F.transform(F.split("description", "\n"), clean_line), lambda x: x != "")
    rows = rows.transform(settle, {"lines": lines}).filter(F.size("lines") > 0)
    segments = F.filter(
        F.transform(F.split(F.col("lines")[0], "\\|"), clean_candidate), lambda x: x != ""
    )
    rows = rows.transform(settle, 
        {
            "segments": segments,
            "remote": has_pattern(F.col("description"), [r"\bremote\b"]),
        }
    )
    first = clean_candidate(F.coalesce(F.try_element_at("segments", F.lit(1)), F.col("lines")[0]))
    company = replace(first, r"(?i)\s+\((?:https?://)?[a-z0-9.-]+\.[a-z]{2,}(?:/[^)]*)?\)$", "")
    later = F.slice("segments", 2, 1 << 20)
    announced = F.transform(F.slice("lines", 2, 1 << 20), _line_title)
    titles = F.filter(
        F.transform(F.array_compact(F.concat(later, announced)), clean_candidate),
        lambda t: (t != "") & has_tech_signal(t) & ~_website(t) & ~_employment(t),
    )
    early = F.when(F.col("_early"), "entry_level")
    rated = F.filter(
        F.transform(
            F.col("titles"),
            lambda t: F.struct(
                t.alias("title"),
                F.coalesce(level_of(t, F.col("_rescued"), F.col("_new_grad")), early).alias("level"),
            ),
        ),
        lambda r: r["level"].isNotNull(),
    )
    rows = rows.transform(settle, {"company": company, "titles": titles})
    rows = rows.filter((F.col("company") != "") & (F.size("titles") > 0))
    rows = rows.transform(settle,  # once per comment, whatever the number of its titles
        {
            "_rescued": says_rescue(F.col("description")),
            "_new_grad": says_new_grad(F.col("description")),
            "_early": has_pattern(F.col("description"), [EARLY_CAREER]),
        }
    )
    rows = rows.transform(settle, {"_best": F.try_element_at(rated, F.lit(1))}).filter("_best IS NOT NULL")
    rows = rows.transform(settle, 
        {"title": F.col("_best.title"), "experience_level": F.col("_best.level")}
    )
    places = F.filter(
        later,
        lambda s: ~_website(s) & ~_employment(s) & (F.lower(s) != F.lower("title")) & ~has_tech_signal(s),
    )
    rows = rows.withColumn("_places", places)
    named = F.filter("_places", lambda s: has_pattern(s, [r"\bremote\b"]))
    place = F.coalesce(
        F.try_element_at(named, F.lit(1)),
        F.try_element_at("_places", F.lit(1)),
        F.when(F.col("remote"), "Remote"),
    )
    link = first_of_all_urls(F.col("text"))
    rows = rows.transform(settle, 
        {
            "location": place,
            "source_id": F.col("id").cast("string"),
            "url": F.coalesce(link, F.concat(F.lit(ITEM_URL), F.col("id"))),
            "posted_at": F.when(F.col("time") != 0, F.timestamp_seconds("time")),
        }
    )
    rows = rows.filter(F.col("remote") | ~is_non_us(F.col("location")))
    return dedupe_by(finalize(rows, "hackernews"), ["dedup_hash"], ["ingest_seq"], keep="last")
