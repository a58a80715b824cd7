"""Location text from structured fields, one rule per board family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .location import infer_remote
from .regex import let, replace
from .text import blank_to_null


def first_named(*names: Column) -> Column:
    """The first name that is not blank, trimmed."""
    return F.coalesce(*[blank_to_null(n) for n in names])


def joined(*parts: Column) -> Column:
    """The parts that are not blank, with commas; null when none is left."""
    kept = F.array_compact(F.array(*[blank_to_null(p) for p in parts]))
    return F.nullif(F.array_join(kept, ", "), F.lit(""))


def city_country(city: Column, country: Column) -> Column:
    """``City, Country``, or the city alone when both are the same; null unless both."""
    city, country = blank_to_null(city), blank_to_null(country)
    return F.when(F.lower(city) == F.lower(country), city).otherwise(
        F.concat(city, F.lit(", "), country)
    )


def address(city: Column, region: Column, country: Column) -> Column:
    """City, region, and the country unless it is the home country."""
    country = blank_to_null(country)
    return joined(city, region, F.when(country != "US", country))


def distinct_joined(separator: str, *parts: Column) -> Column:
    kept = F.array_distinct(F.array_compact(F.array(*[blank_to_null(p) for p in parts])))
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def short_country(name: Column) -> Column:
    """``Remote`` for telecommuting; a trailing home country is dropped."""
    name = blank_to_null(name)
    short = blank_to_null(replace(name, "(?i),\\s*United States$", ""))
    return F.when(name.rlike("(?i)^(?:telecommute|remote)\\z"), "Remote").otherwise(
        F.coalesce(short, name)
    )


def listed_place(names: Column, structured: Column) -> Column:
    """The first listed place that is not remote, else the first, else the structured one."""
    places = F.array_compact(F.transform(names, short_country))
    on_site = F.filter(places, lambda p: ~infer_remote(p))
    return F.coalesce(
        F.try_element_at(on_site, F.lit(1)),
        F.try_element_at(places, F.lit(1)),
        short_country(structured),
    )


def state_code_place(code: Column) -> Column:
    """``US-CA-San-Jose`` becomes ``San Jose, CA``; other text stays."""
    code = blank_to_null(code)
    state = F.regexp_extract(code, "^US-([A-Z]{2})-(.+)$", 1)
    city = F.trim(F.regexp_replace(F.regexp_extract(code, "^US-([A-Z]{2})-(.+)$", 2), "-", " "))
    return let(
        F.struct(state.alias("state"), city.alias("city")),
        lambda p: F.when(p["state"] == "", code)
        .when(p["city"] == "", p["state"])
        .when(F.lower(p["city"]) == "remote", "Remote, United States")
        .otherwise(F.concat(p["city"], F.lit(", "), p["state"])),
    )


# Spellings of the home country.
HOME_COUNTRY = ["us", "usa", "united states", "united states of america"]


def country_name(country: Column) -> Column:
    country = blank_to_null(country)
    return F.when(F.lower(country).isin(HOME_COUNTRY), "United States").otherwise(country)
