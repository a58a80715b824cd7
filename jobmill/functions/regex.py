"""Regex helpers: ECMAScript classes in Java syntax, and word packs as one pattern.

The rules were written for a dialect in which ``\\s`` covers Unicode spaces and ``\\b``
is ASCII. Java differs on the first and, up to JDK 18, on the second, so both are
spelled out here.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE_MEMBERS = "\\t\\n\\x0B\\f\\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
#: as one class, every letter would be compared with each of the rare spaces in turn; the
#: common ones are spelled out, because Java looks up a class of single characters at once
SPACE = (
    "(?:[\\t\\n\\x0B\\f\\r \u00a0]|(?=[\u1680-\uffff])"
    "[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff])"
)
#: the same characters as plain text
SPACE_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
#: ASCII letters, digits and ``_``, which Java looks up at once; a class tests each range
_WORD = "\\w"
_START = f"(?<!{_WORD})"
_END = f"(?!{_WORD})"
_EDGE = f"(?:(?<={_WORD}){_END}|{_START}(?={_WORD}))"


def _edge(before: str, after: str) -> str:
    """The cheapest form of ``\\b`` between the pattern texts on its two sides."""
    if re.match(r"[A-Za-z0-9_](?![*?{])|\\d(?![*?{])", after):
        return _START
    if re.search(r"(?:^|[^\\])[A-Za-z0-9_]\Z", before):
        return _END
    return _EDGE


def ecma(pattern: str) -> str:
    """Java form of an ECMAScript pattern without the ``u`` flag."""
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair == "\\b" and not in_class:
            out.append(_edge(pattern[:i], pattern[i + 2 :]))
            i += 2
        elif pair == "\\s":
            out.append(SPACE_MEMBERS if in_class else SPACE)
            i += 2
        elif pair[0] == "\\":
            out.append(pair)
            i += 2
        else:
            if pair[0] == "[" and not in_class:
                in_class = True
            elif pair[0] == "]":
                in_class = False
            out.append(pair[0])
            i += 1
    return "".join(out)


def quote(text: str) -> str:
    """``text`` as a literal in a Java pattern."""
    return re.sub(r"([.*+?^${}()|\[\]\\/&~#-])", r"\\\1", text)


def _minimal(words: Iterable[str]) -> list[str]:
    """Drop words that contain another word: as a substring test they add nothing."""
    kept: list[str] = []
    for word in sorted(set(words), key=len):
        if not any(k in word for k in kept):
            kept.append(word)
    return kept


#: branches tried in a row before they are grouped behind a character class
_FAN_OUT = 5


def _first_of(chars: Iterable[str]) -> str:
    return f"(?=[{''.join(map(quote, chars))}])"


def _branch(tree: dict) -> str:
    chars = sorted(tree)
    options = [quote(c) + ("" if tree[c] is None else _branch(tree[c])) for c in chars]
    if len(options) == 1:
        return options[0]
    if len(options) > _FAN_OUT:
        # The engine tries branches one by one; a class test skips a whole group.
        cuts = range(0, len(options), _FAN_OUT)
        options = [
            f"{_first_of(chars[i : i + _FAN_OUT])}(?:{'|'.join(options[i : i + _FAN_OUT])})"
            for i in cuts
        ]
    return "(?:" + "|".join(options) + ")"


@lru_cache(maxsize=None)
def _word_pattern(words: tuple[str, ...]) -> str:
    tree: dict = {}
    for word in _minimal(words):
        node = tree
        for char in word[:-1]:
            node = node.setdefault(char, {})
        node[word[-1]] = None
    # A look at the first character spares most positions of a long text all branches.
    return _first_of(sorted(tree)) + _branch(tree)


def _longest(tree: dict) -> str:
    """The longest word of a tree; ``""`` marks the end of a word."""
    chars = sorted(c for c in tree if c)
    if not chars:
        return ""
    options = [quote(c) + _longest(tree[c]) for c in chars]
    if len(options) > _FAN_OUT:
        cuts = range(0, len(options), _FAN_OUT)
        options = [
            f"{_first_of(chars[i : i + _FAN_OUT])}(?:{'|'.join(options[i : i + _FAN_OUT])})"
            for i in cuts
        ]
    if len(options) == 1 and "" not in tree:
        return options[0]
    return f"(?:{'|'.join(options)}){'?' if '' in tree else ''}"


@lru_cache(maxsize=None)
def _longest_pattern(words: frozenset[str]) -> str:
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}
    return f"{_first_of(sorted(tree))}(?=({_longest(tree)}))"


_LINE_ENDS = "\\n\\r\u0085\u2028\u2029"


def automaton(pattern: str) -> str:
    """Form of a lower-case ECMAScript pattern for an engine without backtracking.

    There ``\\b`` is ASCII already; ``\\s`` and the dot are spelled out.
    """
    if not pattern.isascii() or "(?" in pattern.replace("(?:", "") or re.search("[A-Z]", pattern):
        raise ValueError(f"no plain lower-case pattern: {pattern}")
    out, in_class = [], False
    for token in re.findall(r"\\.|.", pattern, re.DOTALL):
        if token == "\\s":
            token = SPACE_MEMBERS if in_class else f"[{SPACE_MEMBERS}]"
        elif token == "." and not in_class:
            token = f"[^{_LINE_ENDS}]"
        elif token in ("[", "]"):
            in_class = token == "["
        out.append(token)
    return "".join(out)


@lru_cache(maxsize=None)
def _any_word(words: tuple[str, ...]) -> str:
    plain = _minimal(w for w in words if "\\b" not in w)
    return "|".join([*map(re.escape, plain), *(automaton(w) for w in words if "\\b" in w)])


def any_word(words: Iterable[str]) -> str:
    """A pattern for ``matches``: what ``has_word`` looks for in a lower-cased text."""
    return _any_word(tuple(words))


def any_pattern(patterns: Iterable[str]) -> str:
    """A pattern for ``matches``: what ``has_pattern`` looks for."""
    return "|".join(map(automaton, patterns))


def matches(col: Column, patterns: Iterable[str], ignore_case: bool = False) -> Column:
    """Which of the patterns match somewhere in ``col``, as bits; bit 0 is the first one.

    Java tries the words of a pack one after the other at each position of a text. Arrow's
    engine walks the text once per pack, however many words there are. ``ignore_case``
    folds ASCII letters only. It takes a column of the row, not a variable of a lambda.
    """
    patterns = list(patterns)

    @F.arrow_udf("long")
    def bits(texts: pa.Array) -> pa.Array:
        if ignore_case:
            texts = pc.ascii_lower(texts)
        found = pa.repeat(pa.scalar(0, pa.int64()), len(texts))
        for i, pattern in enumerate(patterns):
            found = pc.add(found, pc.multiply(pc.match_substring_regex(texts, pattern).cast(pa.int64()), 1 << i))
        return found

    return bits(col)


def has_bit(bits: Column, i: int) -> Column:
    """Whether pattern ``i`` of ``matches`` was found."""
    return bits.bitwiseAND(F.lit(1 << i)) != 0


def found_words(col: Column, packs: Iterable[Iterable[str]]) -> Column:
    """The longest word of any pack at each position of ``col``, one a line.

    Every word that begins at a position is a prefix of the longest one there, so the
    lines tell which packs have a word in the text (``found_in``), however many packs
    there are: the text itself is walked once.
    """
    words = frozenset(word for pack in packs for word in _minimal(pack))
    return F.array_join(F.regexp_extract_all(col, F.lit(_longest_pattern(words)), F.lit(1)), "\n")


def found_in(found: Column, words: Iterable[str]) -> Column:
    """Whether one of the lines of ``found_words`` begins with a word of the pack."""
    return found.rlike(f"(?md)^{word_pattern(words)}")


def word_pattern(words: Iterable[str]) -> str:
    """One pattern that finds any of the words as a substring, sharing common prefixes.

    A long chain of ``contains`` overflows the JVM compiler, and an array ``exists``
    tests every word; one pattern walks each title once.
    """
    return _word_pattern(tuple(words))


def has_word(col: Column, words: Iterable[str]) -> Column:
    """True when ``col`` (already lower-cased) contains any word of the pack.

    Entries with ``\\b`` are patterns, all others plain substrings.
    """
    words = list(words)
    plain = [w for w in words if "\\b" not in w]
    patterns = [ecma(w) for w in words if "\\b" in w]
    if plain:
        patterns.insert(0, word_pattern(plain))
    return col.rlike("|".join(patterns))


def has_pattern(col: Column, patterns: Iterable[str]) -> Column:
    """True when any of the ECMAScript patterns matches, ignoring case.

    Patterns that begin at a word start share one test for it, so that inside words no
    pattern is tried.
    """
    java = [ecma(p) for p in patterns]
    at_start = [p.removeprefix(_START) for p in java if p.startswith(_START) and not _top_level_or(p)]
    parts = [f"(?:{p})" for p in java if not p.startswith(_START) or _top_level_or(p)]
    if at_start:
        parts.insert(0, f"{_START}{_by_first_letter(at_start)}")
    return col.rlike("(?i)" + "|".join(parts))


def _by_first_letter(patterns: list[str]) -> str:
    """Any of the patterns; those that begin with the same letter are tried behind it."""
    groups: dict[str, list[str]] = {}
    rest: list[str] = []
    for p in patterns:
        plain = re.match(r"[A-Za-z](?![?*+{])", p)
        groups.setdefault(p[0].lower(), []).append(p[1:]) if plain else rest.append(p)
    options = [c + (ends[0] if len(ends) == 1 else f"(?:{'|'.join(ends)})") for c, ends in sorted(groups.items())]
    if len(options) > _FAN_OUT:
        chars = sorted(groups)
        options = [
            f"{_first_of(chars[i : i + _FAN_OUT])}(?:{'|'.join(options[i : i + _FAN_OUT])})"
            for i in range(0, len(options), _FAN_OUT)
        ]
    return f"(?:{'|'.join(options + rest)})"


def _top_level_or(pattern: str) -> bool:
    depth = 0
    for i, char in enumerate(pattern):
        escaped = i > 0 and pattern[i - 1] == "\\"
        if char in "([" and not escaped:
            depth += 1
        elif char in ")]" and not escaped:
            depth -= 1
        elif char == "|" and depth == 0 and not escaped:
            return True
    return False


def first_match(col: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null when there is no match or it is empty."""
    return F.nullif(F.regexp_extract(col, ecma(pattern), group), F.lit(""))


def replace(col: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(col, ecma(pattern), by)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
