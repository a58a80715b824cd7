"""Salary text to ``struct(min, max)`` of yearly amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import SPACE, first_match, let

HOURS_PER_YEAR = 2080


def _half_up(amount: Column) -> Column:
    return F.floor(amount + F.lit(0.5)).try_cast("int")


def _number(text: Column) -> Column:
    """The number a text starts with."""
    return F.regexp_extract(text, "^(\\d*\\.?\\d*)", 1).try_cast("double")


def _range(low: Column, high: Column) -> Column:
    return F.struct(low.alias("min"), high.alias("max"))


def parse_salary(col: Column, dialect: str) -> Column:
    """``struct(min int, max int)``, both null when the text holds no salary.

    ``summary``  ``$50/hr``, ``$120K - $150K``, ``$120K``, ``$120,000 - $150,000``
    ``numbers``  least and greatest number of at least 1,000 (``k`` counts thousands)
    ``tokens``   first two numbers, with ``k`` and ``m``
    """
    col = F.coalesce(col, F.lit(""))
    if dialect == "summary":
        return _summary(F.translate(col, ",", ""))
    if dialect == "numbers":
        return _numbers(col)
    if dialect == "tokens":
        return _tokens(col)
    raise ValueError(f"unknown dialect {dialect}")


def _summary(text: Column) -> Column:
    def part(pattern: str, group: int) -> Column:
        return _number(first_match(text, pattern, group))

    hour = r"(?i)\$?([\d.]+)\s*/\s*hr"
    range_k = r"(?i)\$?([\d.]+)K?\s*[-–]\s*\$?([\d.]+)K"
    single_k = r"(?i)\$?([\d.]+)K"
    plain = r"\$?(\d+)\s*[-–]\s*\$?(\d+)"
    hourly = _half_up(part(hour, 1) * HOURS_PER_YEAR)
    single = _half_up(part(single_k, 1) * 1000)
    return (
        F.when(first_match(text, hour).isNotNull(), _range(hourly, hourly))
        .when(
            first_match(text, range_k).isNotNull(),
            _range(_half_up(part(range_k, 1) * 1000), _half_up(part(range_k, 2) * 1000)),
        )
        .when(first_match(text, single_k).isNotNull(), _range(single, single))
        .otherwise(
            _range(
                first_match(text, plain, 1).try_cast("int"),
                first_match(text, plain, 2).try_cast("int"),
            )
        )
    )


def _numbers(text: Column) -> Column:
    text = F.regexp_replace(F.translate(text, ",", ""), "(?i)USD", "")
    found = F.regexp_extract_all(text, F.lit("(?i)(\\d+(?:\\.\\d+)?k?)"), F.lit(1))
    amounts = F.filter(
        F.transform(
            found,
            lambda v: _half_up(_number(v) * F.when(F.lower(v).endswith("k"), 1000).otherwise(1)),
        ),
        lambda v: v >= 1000,
    )
    return let(
        amounts,
        lambda a: _range(F.array_min(a), F.when(F.size(a) > 1, F.array_max(a))),
    )


def _tokens(text: Column) -> Column:
    found = F.regexp_extract_all(
        text, F.lit(f"(\\$?\\d[\\d,.]*(?:\\.\\d+)?{SPACE}*[kKmM]?)"), F.lit(1)
    )

    def amount(token: Column) -> Column:
        plain = F.lower(F.regexp_replace(token, f"[$,]|{SPACE}", ""))
        unit = F.when(plain.endswith("k"), 1000).when(plain.endswith("m"), 1000000).otherwise(1)
        return _half_up(F.regexp_replace(plain, "[km]\\z", "").try_cast("double") * unit)

    return let(
        F.array_compact(F.transform(found, amount)),
        lambda a: _range(F.try_element_at(a, F.lit(1)), F.try_element_at(a, F.lit(2))),
    )


def parse_annual(interval: Column, low: Column, high: Column) -> Column:
    """Yearly pay record: amounts count only for the interval ``PA``."""

    def amount(col: Column) -> Column:
        return F.when(interval == "PA", _half_up(_number(col)))

    return _range(amount(low), amount(high))
