"""Rule classifiers: roles, experience level, title gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import packs_gates as gates
from . import packs_levels as levels
from . import packs_roles as roles_packs
from .location import is_non_us
from .regex import any_pattern, any_word, has_bit, has_pattern, has_word, matches
from .text import has_non_latin, js_trim

# Role tags, in output order.
ROLES = ["swe", "ds", "ml", "ai", "analyst", "pm", "security", "devops", "consulting", "finance"]
TARGET_ROLES = ["swe", "ds", "ml", "ai", "analyst", "pm"]
LEVELS = ["new_grad", "entry_level", "internship"]

ROLE_PACKS = {r: getattr(roles_packs, f"ROLE_{r.upper()}") for r in ROLES}
TARGET_PACKS = {r: getattr(roles_packs, f"TARGET_{r.upper()}") for r in TARGET_ROLES}

# Keyword lists of single sources.
BOARD_TECH_WORDS = [
    "engineer", "developer", "scientist", "analyst", "ml", "ai", "data", "software",
    "backend", "frontend", "fullstack", "full stack", "product manager",
]
REMOTE_BOARD_TECH_WORDS = [
    "engineer", "developer", "scientist", "analyst", "ml", "ai", "data", "backend",
    "frontend", "fullstack", "product", "design", "manager", "devops", "cloud", "security",
    "mobile", "ios", "android", "python", "javascript", "typescript", "react", "node",
    "java", "golang", "rust",
]
TAG_WORDS = [
    "software-engineer", "developer", "data", "machine-learning", "backend", "frontend",
    "fullstack", "analyst", "engineering", "javascript", "python", "react", "node", "java",
    "typescript", "cloud", "devops", "mobile", "product",
]
TAGGED_TITLE_WORDS = [
    "engineer", "developer", "analyst", "scientist", "manager", "designer", "devops",
    "cloud", "security",
]
PROFILE_LEVELS = {
    "Entry Level": "entry_level", "Internship": "internship", "New Grad": "new_grad",
    "entry_level": "entry_level", "internship": "internship", "new_grad": "new_grad",
}


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _found(lower: Column, packs: dict[str, list[str]]) -> dict[str, Column]:
    """For each tag whether the text has a word of its pack; an empty pack has none."""
    bits = matches(lower, [any_word(words) for words in packs.values() if words])
    tags = [tag for tag, words in packs.items() if words]
    return {tag: has_bit(bits, tags.index(tag)) if tag in tags else F.lit(False) for tag in packs}


def _tags(found: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(yes, F.lit(tag)) for tag, yes in found.items()]))


def has_tech_signal(title: Column, patterns: list[str] = roles_packs.TECH_SIGNAL) -> Column:
    return has_pattern(_text(title), patterns)


def infer_roles(title: Column, packs: dict[str, list[str]] = ROLE_PACKS) -> Column:
    """Role tags in fixed order.

    Physical engineering titles lose ``swe`` unless a software word saves it. A title
    with no tag but a technical word becomes ``swe``.
    """
    title = _text(title)
    rules = (roles_packs.NOT_SOFTWARE, roles_packs.SOFTWARE_AFTER_ALL, roles_packs.TECH_SIGNAL)
    found = matches(title, map(any_pattern, rules), ignore_case=True)
    not_software = has_bit(found, 0) & ~has_bit(found, 1)
    tags = _found(F.lower(title), packs)
    untagged = ~reduce(Column.__or__, tags.values(), F.lit(False))
    swe = (tags.get("swe", F.lit(False)) | (untagged & has_bit(found, 2))) & ~not_software
    return _tags(tags | {"swe": swe} if "swe" in tags else {"swe": swe} | tags)


def infer_target_roles(text: Column, packs: dict[str, list[str]] = TARGET_PACKS) -> Column:
    """The six feed roles, by keyword only."""
    return _tags(_found(F.lower(_text(text)), packs))


def explain_experience(title: Column, content: Column | None = None) -> Column:
    """The stage that decides the level of a posting."""
    lower = F.lower(_text(title))
    padded = F.concat(F.lit(" "), lower, F.lit(" "))
    text = F.lower(_text(content)) if content is not None else None

    def in_text(words: list[str]) -> Column:
        return F.lit(False) if text is None else has_word(text, words)

    excluded = has_word(padded, levels.EXCLUSION)
    return (
        F.when(excluded & in_text(levels.RESCUE), "excluded_rescued")
        .when(excluded, "excluded")
        .when(has_word(lower, levels.INTERNSHIP), "internship_title")
        .when(has_word(padded, levels.NEW_GRAD), "new_grad_title")
        .when(in_text(levels.NEW_GRAD_TEXT), "new_grad_text")
        .when(has_word(lower, levels.ENTRY_LEVEL) | in_text(levels.ENTRY_LEVEL), "entry_signal")
        .otherwise("default")
    )


def says_rescue(content: Column) -> Column:
    """Whether a text says that an excluded title is open to beginners after all."""
    return has_word(F.lower(_text(content)), levels.RESCUE)


def says_new_grad(content: Column) -> Column:
    """Whether a text asks for new graduates."""
    return has_word(F.lower(_text(content)), levels.NEW_GRAD_TEXT)


def level_of(title: Column, rescued: Column, new_grad: Column) -> Column:
    """Level of a title, given what its text says; several titles can share one text."""
    lower = F.lower(_text(title))
    padded = F.concat(F.lit(" "), lower, F.lit(" "))
    return (
        F.when(has_word(padded, levels.EXCLUSION), F.when(rescued, F.lit("entry_level")))
        .when(has_word(lower, levels.INTERNSHIP), "internship")
        .when(has_word(padded, levels.NEW_GRAD), "new_grad")
        .when(new_grad, "new_grad")
        .otherwise("entry_level")
    )


def classify_experience(title: Column, content: Column | None = None) -> Column:
    """``internship``, ``new_grad``, ``entry_level``, or null for senior postings.

    The entry-level pack is not tested: its outcome equals the default.
    """
    lower = F.lower(_text(title))
    padded = matches(F.concat(F.lit(" "), lower, F.lit(" ")), [any_word(levels.EXCLUSION), any_word(levels.NEW_GRAD)])
    intern = matches(lower, [any_word(levels.INTERNSHIP)])
    says = F.lit(0) if content is None else matches(
        F.lower(_text(content)), [any_word(levels.RESCUE), any_word(levels.NEW_GRAD_TEXT)]
    )
    return (
        F.when(has_bit(padded, 0), F.when(has_bit(says, 0), F.lit("entry_level")))
        .when(has_bit(intern, 0), "internship")
        .when(has_bit(padded, 1) | has_bit(says, 1), "new_grad")
        .otherwise("entry_level")
    )


def passes_early_career(title: Column, content: Column) -> Column:
    """No senior word in the title and no years asked for, unless a junior word is there."""
    early = any_pattern(levels.EARLY_CAREER)
    named = matches(_text(title), [any_pattern(levels.STRICT_TITLE), early], ignore_case=True)
    asked = matches(_text(content), [any_pattern(levels.TOO_EXPERIENCED), early], ignore_case=True)
    return ~(has_bit(named, 0) | has_bit(asked, 0)) | has_bit(named, 1) | has_bit(asked, 1)


def level_from_codes(experience: Column, employment: Column, title: Column) -> Column:
    """Level from board codes: a level, ``reject``, or null when the codes say nothing."""
    experience = F.lower(js_trim(experience))
    employment = F.lower(js_trim(employment))
    intern = has_pattern(_text(title), [r"\bintern(ship)?\b"])
    return (
        F.when(
            F.coalesce(employment == "internship", F.lit(False))
            | experience.isin("student_college", "student_school"),
            "internship",
        )
        .when(
            experience.isin("experienced", "mid_level", "manager", "senior_manager", "executive"),
            "reject",
        )
        .when(
            experience == "entry_level",
            F.when(intern, F.lit("internship")).otherwise("entry_level"),
        )
    )


def level_from_board_id(board_id: Column, title: Column) -> Column:
    """Level from a board's own level id together with the title; null rejects."""
    board_id = F.lower(js_trim(_text(board_id)))
    inferred = classify_experience(title)
    return (
        F.when(board_id.isin("mid_senior_level", "director", "executive"), F.lit(None))
        .when(inferred.isNull(), F.lit(None))
        .when(board_id == "internship", "internship")
        .when(board_id.isin("associate", "entry_level") & ~inferred.isin("internship", "new_grad"), "entry_level")
        .otherwise(inferred)
    )


def level_from_grade(grade: Column, title: Column, content: Column) -> Column:
    """Level from a government pay grade; without one, from the text. Null rejects."""
    number = F.coalesce(F.regexp_extract(_text(grade), "^\\s*(\\d+)", 1).try_cast("int"), F.lit(0))
    inferred = classify_experience(title, content)
    return (
        F.when(inferred.isNull() | (number >= 12), F.lit(None))
        .when(number == 0, inferred)
        .when(number.between(8, 9), "new_grad")
        .otherwise("entry_level")
    )


def is_senior_or_sales(title: Column) -> Column:
    padded = F.concat(F.lit(" "), F.lower(_text(title)), F.lit(" "))
    junior = has_word(padded, ["associate consultant", "junior consultant"])
    return has_word(padded, gates.SENIOR_SALES_TITLES) | (padded.contains("consultant") & ~junior)


def is_non_tech(title: Column, company: Column) -> Column:
    """Titles outside technology; clearly technical titles are protected."""
    lower = F.lower(_text(title))
    padded = F.concat(F.lit(" "), lower, F.lit(" "))
    software = has_word(padded, gates.SOFTWARE_CONTEXT)
    protected = has_pattern(lower, gates.PROTECTED_TECH)
    return ~protected & (
        (
            lower.contains("process engineer")
            & ~has_pattern(lower, [r"\b(?:software|data)\s+process engineer\b"])
        )
        | (has_word(lower, ["quality assurance", "field engineer"]) & ~software)
        | (
            lower.contains("financial analyst")
            & ~F.lower(_text(company)).isin(gates.TECH_COMPANIES)
        )
        | has_word(lower, gates.NON_TECH_TITLES)
    )


def staged_reject_reason(title: Column, company: Column, location: Column, url: Column) -> Column:
    """The first gate a posting fails, null when it passes all of them."""
    url = _text(url)
    good_url = (
        url.contains("myworkdayjobs.com")
        & url.contains("/job/")
        & ~url.contains("invalid-url")
        & ~url.contains("community.workday.com")
    )
    return (
        F.when(classify_experience(title).isNull(), "level")
        .when(is_senior_or_sales(title), "senior_title")
        .when(is_non_us(location), "non_us")
        .when(has_non_latin(_text(title)) | has_non_latin(_text(location)), "non_latin")
        .when(is_non_tech(title, company), "non_tech")
        .when(~good_url, "bad_url")
    )


def tech_prefilter(title: Column, tags: Column | None = None, kind: str = "board") -> Column:
    """Cheap keyword filter of a source before any classification.

    ``board``, ``remote_board``, ``tagged`` (tags or title), ``signal`` (word or role).
    """
    lower = F.lower(_text(title))
    if kind == "board":
        return has_word(lower, BOARD_TECH_WORDS)
    if kind == "remote_board":
        return has_word(lower, REMOTE_BOARD_TECH_WORDS)
    if kind == "tagged":
        in_title = has_word(lower, TAG_WORDS + TAGGED_TITLE_WORDS)
        if tags is None:
            return in_title
        in_tags = F.exists(tags, lambda t: has_word(F.lower(t), TAG_WORDS))
        return in_title | F.coalesce(in_tags, F.lit(False))
    if kind == "signal":
        return has_tech_signal(title) | (F.size(infer_roles(title)) > 0)
    raise ValueError(f"unknown kind {kind}")


def normalize_roles(roles: Column, strict: bool = False) -> Column:
    """Known role tags, distinct, in order. Strict: null when any tag is unknown."""
    cleaned = F.transform(roles, lambda r: F.lower(js_trim(r)))
    known = F.array_distinct(F.filter(cleaned, lambda r: r.isin(ROLES)))
    if strict:
        unknown = F.exists(cleaned, lambda r: r.isNull() | ~r.isin(ROLES))
        return F.when(~unknown, known)
    return F.coalesce(known, F.array().cast("array<string>"))


def map_profile_levels(labels: Column) -> Column:
    """Level codes of the labels a profile stores, distinct, in order."""
    table = F.create_map(*[F.lit(x) for pair in PROFILE_LEVELS.items() for x in pair])
    codes = F.transform(labels, lambda v: F.try_element_at(table, v))
    return F.array_distinct(F.array_compact(F.coalesce(codes, F.array().cast("array<string>"))))
