"""Location rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .packs_places import (
    NON_US_SIGNALS,
    US_CITIES,
    US_CITY_CODES,
    US_STATE_CODES,
    US_STATE_NAMES,
)
from .regex import any_pattern, any_word, automaton, ecma, has_bit, has_pattern, has_word, matches, word_pattern
from .text import blank_to_null, js_trim

# Fixed values of the country rules.
US_BARE = ["us", "hybrid", "remote", "huntington beach"]
US_SPECIAL = ["afb", "naval", "pentagon", "quantico", "langley"]
REMOTE_SIGNALS = ["remote", "anywhere", "distributed", "work from home", "wfh"]
US_LIKE_MARKERS = [
    "united states", ", usa", "remote", ", ca", ", ny", ", tx", ", wa", ", ma", ", il",
    ", ga", ", co", ", fl", ", va", ", pa", ", nc", ", az", ", or", ", mn", ", mi", ", oh",
]
CANADIAN_PROVINCES = "ab|bc|mb|nb|nl|ns|nt|nu|on|pe|qc|sk|yt"

_STATES = "|".join(US_STATE_CODES)
_STATE_NAMES = "|".join(US_STATE_NAMES)

#: patterns that each make a location count as the United States
US_PATTERNS = [
    r"\b(?:united states|usa)\b|\bu\.s\.a?\.?(?=\s|,|$)",
    rf",\s*(?:{_STATES})(?=\b|\s|,|$)",
    rf"(?:^|[^a-zA-Z])(?:{'|'.join(US_CITY_CODES)})(?:[^a-zA-Z]|$)",
    r"\b\d+\s+locations?\b",
    r"\bUS,\s*[^,]+",
    rf"\b(?:{_STATES})-[A-Z0-9][A-Z0-9 -]*-\d+\b",
    rf"\b(?:{_STATE_NAMES})\b",
]


def infer_remote(location: Column) -> Column:
    """The text names remote work."""
    return F.coalesce(has_word(F.lower(location), REMOTE_SIGNALS), F.lit(False))


def is_usa(location: Column, remote: Column | None = None) -> Column:
    """Remote and unknown places count as the United States."""
    place = blank_to_null(location)
    lower = F.lower(place)
    # ``matches`` knows no look ahead; at the end of a pattern the character may be taken.
    marked = [p.replace("(?=", "(?:").replace("|$)", "|\\x85?$)").lower() for p in US_PATTERNS]
    found = matches(place, [automaton(r"\bperth,\s*wa\b"), any_pattern(marked)], ignore_case=True)
    named = matches(lower, [any_word([c.lower() for c in US_CITIES] + US_SPECIAL)])
    result = (
        F.when(place.isNull(), True)
        .when(has_bit(found, 0), False)
        .when(lower.isin(US_BARE), True)
        .otherwise(has_bit(found, 1) | has_bit(named, 0))
    )
    if remote is None:
        return result
    return F.when(F.coalesce(remote, F.lit(False)), True).otherwise(result)


def is_non_us(location: Column) -> Column:
    """A foreign place name or a Canadian province, in the text or after `` - ``.

    The name test on the suffix is implied by the one on the whole text; the province
    test is not, because it is anchored.
    """
    lower = F.lower(F.coalesce(location, F.lit("")))
    pattern = ecma(rf"(?:^|,\s)(?:{CANADIAN_PROVINCES})(?=, |\z)")
    suffix = js_trim(F.regexp_extract(lower, "(?s)^.*? - (.*)\\z", 1))
    return lower.rlike(f"{word_pattern(NON_US_SIGNALS)}|{pattern}") | suffix.rlike(pattern)


def us_like(location: Column) -> Column:
    """Marker test used to put postings first in the embedding queue."""
    marked = has_word(F.lower(location), US_LIKE_MARKERS)
    return F.when(F.coalesce(location, F.lit("")) == "", True).otherwise(marked)


# Fixed values of the office rule of XML boards.
OFFICE_CITIES = [
    "new york", "san francisco", "seattle", "boston", "chicago", "austin", "los angeles",
    "atlanta", "denver", "washington", "dallas", "houston", "philadelphia", "san jose",
    "san diego", "raleigh", "durham", "charlotte", "miami", "nashville", "portland",
    "phoenix", "irvine", "palo alto", "mountain view", "menlo park", "redmond", "bellevue",
    "cambridge", "arlington",
]


def office_remote(location: Column, description: Column, more_offices: Column) -> Column:
    """Remote is named in the office, the description or any further office."""
    text = F.concat_ws("\n", location, description, F.array_join(more_offices, "\n"))
    return F.lower(text).contains("remote")


def keep_office(
    location: Column,
    description: Column,
    more_offices: Column,
    cities: list[str] = OFFICE_CITIES,
) -> Column:
    """Location gate of XML boards: unknown, remote or in the United States."""
    in_us = has_pattern(
        location,
        [
            r"\b(?:united states|united states of america|usa|u\.s\.|us-only|us remote|remote us)\b",
            r"^\d+\s+locations?$",
            rf"(?:^|,\s)(?:{_STATES})(?:\b|,|\s|$)",
            rf"\b(?:{_STATE_NAMES})\b",
        ],
    ) | has_word(F.lower(location), cities)
    return (
        F.when(F.coalesce(location, F.lit("")) == "", True)
        .when(office_remote(location, description, more_offices), True)
        .otherwise(in_us)
    )
