"""Text clean-up functions, all ``Column -> Column``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import SPACE, SPACE_CHARS, SPACE_MEMBERS, first_match, let, replace

# Legal-form and filler words that do not tell companies apart.
BUSINESS_SUFFIXES = [
    "co", "company", "corp", "corporation", "gmbh", "healthcare", "inc",
    "incorporated", "llc", "ltd", "plc",
]

# Company names whose spelling does not follow from their slug.
SLUG_NAMES = {
    "doordash": "DoorDash", "epic-games": "Epic Games", "gitlab": "GitLab",
    "github": "GitHub", "grafana-labs": "Grafana Labs", "hims-hers": "Hims & Hers",
    "honeycomb-io": "Honeycomb.io", "jfrog": "JFrog", "jumpcloud": "JumpCloud",
    "khan-academy": "Khan Academy", "launchdarkly": "LaunchDarkly",
    "modern-treasury": "Modern Treasury", "mongodb": "MongoDB", "o3-world": "O3 World",
    "openai": "OpenAI", "opengov": "OpenGov", "pagerduty": "PagerDuty",
    "readme": "ReadMe", "scale-ai": "Scale AI", "scout-rx": "Scout RX",
    "strongdm": "StrongDM", "telemetry2u": "Telemetry2U", "tiktok": "TikTok",
    "usertesting": "UserTesting",
}


def js_trim(col: Column) -> Column:
    """Trim Unicode spaces at both ends (Spark's ``trim`` only strips U+0020)."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def squash_ws(col: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    # Printable ASCII without double spaces is the common case and needs no rewriting.
    return let(
        col,
        lambda c: F.trim(
            F.when(c.rlike("[^!-~ ]|  "), F.regexp_replace(c, f"{SPACE}+", " ")).otherwise(c)
        ),
    )


def blank_to_null(col: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(js_trim(col), F.lit(""))


def clean_unicode(col: Column) -> Column:
    """Drop NUL characters. Lone surrogates cannot occur in a Spark string."""
    return F.translate(col, "\x00", "")


def _decode_numeric(col: Column, pattern: str, base: int) -> Column:
    """Replace each numeric character reference in one pass over the text."""

    def char(code: Column) -> Column:
        number = F.conv(code, base, 10).cast("decimal(20,0)") % 65536
        number = number.cast("int")
        surrogate = number.between(0xD800, 0xDFFF)
        shown = F.decode(F.unhex(F.lpad(F.hex(number), 4, "0")), "UTF-16BE")
        return F.when(surrogate, F.lit("")).otherwise(shown)

    def decoded(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(1))
        pieces = F.split(text, f"(?i){pattern.replace('(', '(?:')}", -1)
        joined = F.zip_with(
            pieces, F.transform(found, char), lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))
        )
        return F.when(text.contains("&#"), F.array_join(joined, "")).otherwise(text)

    return let(col, decoded)


# Named references in the order they are decoded. ``&amp;`` comes first,
# so a doubly escaped reference is decoded twice.
ENTITIES = [
    ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
    ("&lt;", "<"), ("&gt;", ">"),
]


def decode_named(col: Column, ignore_case: bool = False, apostrophe: bool = False) -> Column:
    flag = "(?i)" if ignore_case else ""

    def decoded(text: Column) -> Column:
        for entity, char in ENTITIES:
            if apostrophe and entity == "&#39;":
                entity = "(?:&#39;|&apos;)"
            if flag or entity.startswith("(?:"):
                text = F.regexp_replace(text, flag + entity, char)
            else:
                text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    # Every reference begins with the same character, which few texts have.
    return let(col, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))


def decode_entities(col: Column) -> Column:
    """Numeric references (decimal, then hex), then the named ones in order."""
    col = _decode_numeric(col, "&#([0-9]+);", 10)
    col = _decode_numeric(col, "&#x([0-9a-f]+);", 16)
    return decode_named(col)


def _tidy_lines(col: Column) -> Column:
    col = F.translate(col, "\r", "")
    col = F.regexp_replace(col, "\n{3,}", "\n\n")
    col = F.regexp_replace(col, "[ \t]+", " ")
    col = F.regexp_replace(col, "[ \t]*\n[ \t]*", "\n")
    return js_trim(col)


#: printable ASCII without markup: what most fields hold. The members
#: are spelled out, because Java looks up a class of single characters at once
_PLAIN = "^[{}]*\\z".format(
    "".join(re.sub(r"([\\\[\]^&-])", r"\\\1", chr(c)) for c in range(0x20, 0x7F) if chr(c) not in "<&")
)
#: anything that a clean-up may change, apart from spaces at the ends
_MARKUP = f"[<&\\x00]|(?! ){SPACE}|  "


def strip_html(col: Column, dialect: str = "block") -> Column:
    """Readable text of an HTML fragment.

    ``block``  entities first, then line breaks for ``br``/``p``/``li``, ``- `` items
    ``xml``    as block, CDATA unwrapped, paragraphs not broken
    ``flat``   every tag becomes one space, nothing else
    ``line``   flat, white space squashed
    ``page``   style and script blocks removed, then as line
    ``sections``  line breaks after ``p``, ``div``, lists and headings; entities last
    ``comment``   thread comments: links keep their text; entities last
    """
    if dialect == "flat":
        return F.regexp_replace(col, "<[^>]*>", " ")
    # Most fields are plain text, which one test tells.
    return let(
        col,
        lambda c: F.when(c.rlike(_PLAIN) & ~c.contains("  "), F.trim(c))
        .when(c.rlike(_MARKUP), _strip(c, dialect))
        .otherwise(clean_unicode(js_trim(c))),
    )


def _strip(col: Column, dialect: str) -> Column:
    if dialect == "line":
        return squash_ws(F.regexp_replace(col, "<[^>]*>", " "))
    if dialect == "page":
        col = decode_named(col, ignore_case=True, apostrophe=True)
        col = F.regexp_replace(col, "(?is)<style.*?</style>", " ")
        col = F.regexp_replace(col, "(?is)<script.*?</script>", " ")
        return squash_ws(F.regexp_replace(col, "<[^>]+>", " "))
    if dialect == "sections":
        col = replace(col, "(?i)<br\\s*/?>", "\n")
        col = F.regexp_replace(col, "(?i)</(?:p|div|li|ul|ol|h[1-6])>", "\n")
        col = decode_named(F.regexp_replace(col, "<[^>]+>", " "), ignore_case=True)
        col = F.regexp_replace(F.translate(col, "\r", ""), "[ \t]+\n", "\n")
        col = F.regexp_replace(col, "\n{3,}", "\n\n")
        return js_trim(F.regexp_replace(col, "[ \t]{2,}", " "))
    if dialect == "comment":
        col = replace(col, "(?i)<p>|<br\\s*/?>|</p>", "\n")
        col = replace(col, "(?i)<li\\b[^>]*>", "- ")
        col = F.regexp_replace(col, "(?i)</li>", "\n")
        col = replace(col, "(?i)<a\\b[^>]*>(.*?)</a>", "$1")
        col = F.regexp_replace(col, "<[^>]+>", " ")
        col = let(col, lambda c: F.when(c.contains("&"), _comment_entities(c)).otherwise(c))
        col = F.regexp_replace(F.translate(col, "\r", ""), "[ \t]+\n", "\n")
        col = F.regexp_replace(col, "\n[ \t]+", "\n")
        col = F.regexp_replace(col, "[ \t]{2,}", " ")
        return js_trim(F.regexp_replace(col, "\n{3,}", "\n\n"))
    if dialect == "xml":
        col = decode_named(F.regexp_replace(col, "(?s)<!\\[CDATA\\[(.*?)\\]\\]>", "$1"))
    elif dialect == "block":
        col = decode_entities(col)
    else:
        raise ValueError(f"unknown dialect {dialect}")
    col = replace(col, "(?i)<br\\s*/?>", "\n")
    if dialect == "block":
        col = F.regexp_replace(col, "(?i)</p>", "\n\n")
    col = F.regexp_replace(col, "(?i)</li>", "\n")
    col = F.regexp_replace(col, "(?i)<li[^>]*>", "- ")
    col = F.regexp_replace(col, "<[^>]+>", " ")
    return clean_unicode(_tidy_lines(col))


def _comment_entities(col: Column) -> Column:
    col = _decode_numeric(col, "&#([0-9]+);", 10)
    col = _decode_numeric(col, "&#x([0-9a-f]+);", 16)
    col = F.regexp_replace(col, "(?i)&nbsp;", " ")
    return decode_named(col, ignore_case=True, apostrophe=True)


def truncate_text(col: Column, limit: int) -> Column:
    """At most ``limit`` characters, the cut marked by three dots."""
    cut = F.rtrim(F.substring(col, 1, max(0, limit - 3)), F.lit(SPACE_CHARS))
    return F.when(F.length(col) <= limit, col).otherwise(F.concat(cut, F.lit("...")))


def extract_first_url(col: Column) -> Column:
    """The first quoted ``href``; without one, the first Markdown link target."""
    href = first_match(col, '(?i)href="([^"]+)"')
    return F.coalesce(href, first_match(col, "\\((https?://[^)\\s]+)\\)"))


def _href_urls(col: Column) -> Column:
    href = F.regexp_extract_all(col, F.lit('(?i)href="([^"]+)"'), F.lit(1))
    return F.transform(href, lambda u: js_trim(decode_named(decode_entities(u), True, True)))


def _bare_urls(col: Column) -> Column:
    bare = F.regexp_extract_all(
        decode_named(decode_entities(col), True, True),
        F.lit(f"(?i)(?<!\\w)(https?://[^{SPACE_MEMBERS}<>\"')]+)"),
        F.lit(1),
    )
    return F.transform(bare, js_trim)


def extract_all_urls(col: Column) -> Column:
    """Distinct URLs: ``href`` targets first, then bare ones, in order of appearance."""
    urls = F.concat(_href_urls(col), _bare_urls(col))
    return F.array_distinct(F.filter(urls, lambda u: u != ""))


def first_of_all_urls(col: Column) -> Column:
    """The first of ``extract_all_urls``; bare ones are looked for when there is no target."""
    found = (F.filter(urls(col), lambda u: u != "") for urls in (_href_urls, _bare_urls))
    return F.coalesce(*[F.try_element_at(urls, F.lit(1)) for urls in found])


def extract_cell_text(col: Column) -> Column:
    """Plain text of a Markdown or HTML table cell."""
    marked = f"[<\\[*_`~&]|(?! ){SPACE}|  |^ *[^A-Za-z0-9 ]"
    return let(col, lambda c: F.when(c.rlike(marked), _cell_text(c)).otherwise(js_trim(c)))


def _cell_text(col: Column) -> Column:
    col = replace(col, "(?i)<img\\b[^>]*>", "")
    col = replace(col, "(?i)<a\\b[^>]*>(.*?)</a>", "$1")
    col = F.regexp_replace(col, "\\[([^\\]]+)\\]\\((?:[^)]+)\\)", "$1")
    col = F.regexp_replace(col, "<[^>]+>", "")
    col = F.regexp_replace(col, "[*_`~]", "")
    col = F.regexp_replace(col, "(?i)&nbsp;", " ")
    col = F.regexp_replace(col, "(?i)&amp;", "&")
    col = replace(squash_ws(col), "^\u21b3\\s*", "")
    return js_trim(F.regexp_replace(col, "^[^A-Za-z0-9]+", ""))


def canonical_url(col: Column) -> Column:
    """Trimmed, without trailing slashes."""
    return F.rtrim(js_trim(col), F.lit("/"))


def dedupe_url(col: Column) -> Column:
    """Comparison form: no fragment, no trailing slashes, lower case.

    Text that is not an absolute URL keeps its fragment.
    """
    text = squash_ws(col)
    absolute = text.rlike("^(?i)(?:https?://[^/?#]|(?!https?:)[a-z][a-z0-9+.-]*:)")
    bare = F.when(absolute, F.regexp_replace(text, "(?s)#.*\\z", "")).otherwise(text)
    return F.lower(F.rtrim(bare, F.lit("/")))


def dedupe_text(col: Column) -> Column:
    """Comparison form: lower case words of ASCII letters and digits."""
    text = F.replace(F.lower(col), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def root_words(col: Column) -> Column:
    """The first two words of a comparison form that are not legal forms."""
    words = F.filter(F.split(col, " "), lambda w: (w != "") & ~w.isin(BUSINESS_SUFFIXES))
    return F.array_join(F.slice(words, 1, 2), " ")


def company_root(col: Column) -> Column:
    """The first two words of a company name that are not legal forms."""
    return root_words(dedupe_text(col))


def humanize_slug(
    col: Column,
    separators: str = "-",
    acronyms: tuple[str, ...] = (),
    names: dict[str, str] | None = None,
) -> Column:
    """A display name from a slug: parts capitalised, acronyms and known names kept."""

    def part(p: Column) -> Column:
        title = F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))
        return F.when(p.isin(*acronyms), F.upper(p)).otherwise(title) if acronyms else title

    shown = F.array_join(F.transform(F.split(col, separators, -1), part), " ")
    if names:
        table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        shown = F.coalesce(F.try_element_at(table, col), shown)
    return shown


def humanize_board(col: Column) -> Column:
    """Display name of a board slug: ``-``, ``_`` and ``.`` part the words."""
    parts = F.filter(F.split(col, "[-_.]+"), lambda p: p != "")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))), " "
    )


def slugify(col: Column) -> Column:
    """Lower-case words of letters and digits joined by hyphens."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), "^-+|-+\\z", ""
    )


def first_words(col: Column, n: int = 20, label: str = "Why this matches you: ") -> Column:
    """The first ``n`` words after ``label``; quotes and bullets at the start go first."""
    text = squash_ws(F.regexp_replace(col, "^['\"]+|['\"]+\\z", ""))
    text = replace(text, "^[-*]\\s*", "")
    prefix = label.strip().lower()
    text = F.when(
        F.lower(text).startswith(prefix), js_trim(F.substring(text, len(prefix) + 1, 1 << 20))
    ).otherwise(text)
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    return let(
        F.array_join(F.slice(words, 1, n), " "),
        lambda t: F.when(t != "", F.concat(F.lit(label), t)),
    )


def or_label(col: Column, label: str) -> Column:
    """Squashed text, or the label when nothing is left."""
    return F.coalesce(F.nullif(squash_ws(col), F.lit("")), F.lit(label))


def posted_label(posted_at: Column) -> Column:
    """``Posted Mon D, YYYY``."""
    return F.coalesce(
        F.concat(F.lit("Posted "), F.date_format(posted_at, "MMM d, yyyy")),
        F.lit("Posted date unavailable"),
    )


def has_non_latin(col: Column) -> Column:
    """CJK, Hangul, Arabic or Cyrillic characters."""
    return col.rlike("[\u3000-\u9fff\uac00-\ud7af\u0600-\u06ff\u0400-\u04ff]")
