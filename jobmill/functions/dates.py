"""Posting dates in many spellings to timestamps. ``as_of`` stands for the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import first_match, let
from .text import blank_to_null, js_trim


def parse_datetime(col: Column) -> Column:
    """ISO, ``Mon D, YYYY`` or RFC 822 text; anything else is null."""
    text = blank_to_null(col)
    iso = F.when(text.rlike("^\\d{4}(?:-|\\z)"), text.try_cast("timestamp"))
    mail = F.regexp_replace(text, "^[A-Za-z]{3,9}, +", "")
    mail = F.regexp_replace(mail, " (?:GMT|UTC|Z)\\z", " +0000")
    formats = ["d MMM yyyy HH:mm:ss Z", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy"]
    return F.coalesce(iso, *[F.try_to_timestamp(mail, F.lit(f)) for f in formats])


def parse_epoch(col: Column) -> Column:
    """Epoch seconds, or milliseconds above 1e12."""
    millis = F.when(col > 1000000000000, col).otherwise(col * 1000)
    return F.timestamp_millis(millis.cast("bigint"))


def _ago(as_of: Column, amount: Column, unit: str) -> Column:
    amount = amount.try_cast("int")
    return as_of - F.make_interval(**{unit: amount})


def parse_posted(col: Column, as_of: Column, dialect: str = "curated") -> Column:
    """Timestamp of a relative or absolute posting date.

    ``curated``  today, just now, yesterday, ``3d``/``5 hours``/``2w``, ``Mon D``
    ``age``      as curated without ``Mon D``
    ``ago``      today, just now, ``3 days ago``
    ``posted``   ``Posted Today``, ``Posted 30+ Days Ago``
    ``chip``     today, just posted, ``3d``, ``5h``
    ``chip_days``  today, just posted, ``3+ d``
    """
    text = blank_to_null(col)
    lower = F.lower(text)
    if dialect in ("curated", "age"):
        unit_pattern = "^(\\d+)\\s*(h|hr|hrs|hour|hours|d|day|days|w|wk|wks|week|weeks)$"
        amount = first_match(lower, unit_pattern, 1)
        unit = first_match(lower, unit_pattern, 2)
        result = (
            F.when(lower.isin("today", "just now"), as_of)
            .when(lower == "yesterday", _ago(as_of, F.lit(1), "days"))
            .when(unit.startswith("h"), _ago(as_of, amount, "hours"))
            .when(unit.startswith("d"), _ago(as_of, amount, "days"))
            .when(unit.startswith("w"), _ago(as_of, amount, "weeks"))
        )
        if dialect == "curated":
            month_day = text.rlike("^[A-Za-z]{3,9}[ \\t]+\\d{1,2}$")
            this_year = let(
                parse_datetime(
                    F.concat(
                        F.regexp_replace(text, "[ \\t]+", " "),
                        F.lit(", "),
                        F.year(as_of).cast("string"),
                    )
                ),
                lambda d: F.when(
                    d > as_of + F.expr("interval 1 day"), d - F.expr("interval 1 year")
                ).otherwise(d),
            )
            result = result.when(month_day & this_year.isNotNull(), this_year)
        return result.otherwise(parse_datetime(text))
    if dialect == "ago":
        days = first_match(lower, "(\\d+)\\s*d(?:ays?)?\\s+ago")
        return (
            F.when(lower.isin("today", "just now"), as_of)
            .when(days.isNotNull(), _ago(as_of, days, "days"))
            .otherwise(parse_datetime(text))
        )
    if dialect == "posted":
        days = first_match(lower, "(\\d+)\\+?\\s*day")
        return (
            F.when(lower.contains("today") | lower.contains("just posted"), as_of)
            .when(days.isNotNull(), _ago(as_of, days, "days"))
            .otherwise(parse_datetime(text))
        )
    if dialect in ("chip", "chip_days"):
        days = first_match(lower, "(\\d+)\\s*\\+?\\s*d" if dialect == "chip_days" else "(\\d+)\\s*d")
        result = F.when(lower.isin("today", "just posted"), as_of).when(
            days.isNotNull(), _ago(as_of, days, "days")
        )
        if dialect == "chip":
            hours = first_match(lower, "(\\d+)\\s*h")
            result = result.when(hours.isNotNull(), _ago(as_of, hours, "hours"))
        return result.otherwise(parse_datetime(text))
    raise ValueError(f"unknown dialect {dialect}")


def parse_zoneless(col: Column) -> Column:
    """ISO text read as UTC, with or without the ``Z``."""
    text = js_trim(col)
    return parse_datetime(F.when(text.endswith("Z"), text).otherwise(F.concat(text, F.lit("Z"))))
