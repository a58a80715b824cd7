"""Personal data in the bytes of a text: strict matches, near misses, and their votes.

Strict matches follow four fixed rules, leftmost and without overlap per kind. They are
found in linear time from runs of characters, not by a backtracking pattern. All their
characters are ASCII, so bytes serve; ``points`` turns offsets into code points.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np

from .spans import Block, byte_table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_DIGITS = b"0123456789"
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGIT = byte_table(_DIGITS)
LOCAL = byte_table(_LETTERS + _DIGITS + b"._%+-")
HOST = byte_table(_LETTERS + _DIGITS + b"-.")
DIAL = byte_table(_DIGITS + b" ().-")
WORD = byte_table(_LETTERS + _DIGITS + b"_", high=True)
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SPELLED = re.compile(
    rb"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]{1,63}"
    rb"(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z0-9-]{2,63}){1,4}", re.IGNORECASE
)

#: Words before a match that speak for each kind, and words that speak against any of them.
CUES = (
    (b"mail", b"e-mail", b"email", b"contact", b"correo", b"courriel", b"kontakt", b"write"),
    (b"ip", b"host", b"server", b"address", b"addr", b"client", b"remote", b"ping"),
    (b"card", b"visa", b"mastercard", b"amex", b"credit", b"karte", b"carte", b"tarjeta", b"pan"),
    (b"phone", b"tel", b"call", b"fax", b"mobile", b"cell", b"telefon", b"handy", b"whatsapp"),
)
AGAINST = (b"version", b"v", b"ver", b"release", b"isbn", b"order", b"invoice", b"sku", b"build", b"section",
           b"chapter", b"page", b"serial", b"tracking", b"id", b"no", b"nr", b"ref")
#: Endings of hosts that people use; first digits of card issuers; calling codes.
ENDINGS = frozenset(b"com org net edu gov info biz io de fr es it uk eu us ca ch at nl be pl pt br mx jp cn ru in au".split())
ISSUERS = re.compile(rb"4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35")
CODES = re.compile(rb"\+?(?:00)?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")

VOTES = ("rule", "shape", "check", "gazetteer", "context", "edge", "variety")
_CHECK, _CONTEXT = VOTES.index("check"), VOTES.index("context")


class Candidate(NamedTuple):
    """A span of a text of a block, in bytes of the block."""

    row: int
    kind: int
    start: int
    end: int
    strict: bool


def luhn(digits: bytes) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = digit - 48
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def only_digits(data: bytes) -> bytes:
    return bytes(c for c in data if 48 <= c <= 57)


def octet(digits: bytes) -> bool:
    return len(short := digits.lstrip(b"0")) <= 3 and int(short or b"0") <= 255


class Finder:
    """Candidates of one block of texts."""

    def __init__(self, block: Block):
        self.block, self.data = block, block.data.tobytes()
        self.row_of = lambda at: int(np.searchsorted(block.offsets, at, "right")) - 1
        self.digits = block.words(DIGIT)
        self.points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])

    def point(self, row: int, at: int) -> int:
        """Code points between the begin of text ``row`` and byte ``at``."""
        return int(self.points[at] - self.points[self.block.offsets[row]])

    def strict(self) -> list[Candidate]:
        found = [*self._emails(), *self._ips(True), *self._cards(True), *self._phones()]
        return sorted(found, key=lambda c: (c.start, c.kind))

    def near(self, strict: list[Candidate]) -> list[Candidate]:
        """What looks like a match but isn't one; none lies across a strict match."""
        taken = np.zeros(len(self.data) + 1, bool)
        for c in strict:
            taken[c.start : c.end] = True
        found = [*self._ips(False), *self._cards(False), *self._dialled(), *self._spelled()]
        out = []
        for c in sorted(found, key=lambda c: (c.start, c.kind)):
            if not taken[c.start : c.end].any():
                taken[c.start : c.end] = True
                out.append(c)
        return out

    def _emails(self):
        at = np.flatnonzero(self.block.data == ord("@"))
        if not len(at):
            return
        local, host = self.block.words(LOCAL), self.block.words(HOST)
        left = np.searchsorted(local.ends, at)
        right = np.searchsorted(host.starts, at + 1)
        before = 0
        for p, i, j in zip(at.tolist(), left.tolist(), right.tolist(), strict=True):
            if i == len(local.ends) or local.ends[i] != p or j == len(host.starts) or host.starts[j] != p + 1:
                continue
            if (match := _DOMAIN.match(self.data, p + 1, int(host.ends[j]))) is None:
                continue
            row, start = self.row_of(p), max(int(local.starts[i]), before)
            if start < p and self.block.offsets[row] <= start and match.end() <= self.block.offsets[row + 1]:
                yield Candidate(row, EMAIL, start, match.end(), True)
                before = match.end()

    def _chains(self, between: bytes) -> list[tuple[int, int]]:
        """Runs of digits that one of the characters sets apart, as ranges of runs."""
        starts, ends = self.digits.starts, self.digits.ends
        if not len(starts):
            return []
        owner = self.digits.owner()
        joined = (starts[1:] - ends[:-1] == 1) & (owner[1:] == owner[:-1])
        joined &= np.isin(self.block.data[ends[:-1]], np.frombuffer(between, np.uint8))
        first = np.flatnonzero(np.concatenate([[True], ~joined]))
        return list(zip(first.tolist(), [*first[1:].tolist(), len(starts)], strict=True))

    def _ips(self, strict: bool):
        starts, ends = self.digits.starts, self.digits.ends
        for lo, hi in self._chains(b"."):
            for i in range(lo, hi - 3, 4):
                parts = [self.data[starts[k] : ends[k]] for k in range(i, i + 4)]
                if all(map(octet, parts)) == strict:
                    yield Candidate(self.row_of(starts[i]), IP, int(starts[i]), int(ends[i + 3]), strict)

    def _cards(self, strict: bool):
        starts, ends = self.digits.starts, self.digits.ends
        total = np.concatenate([[0], np.cumsum(ends - starts)])
        for lo, hi in self._chains(b" -"):
            size = total[hi] - total[lo]
            if size < 13:
                continue
            digits = only_digits(self.data[starts[lo] : ends[hi - 1]]) if size <= 19 else b""
            row, passes = self.row_of(starts[lo]), 14 <= size <= 19 and luhn(digits)
            if strict:
                if passes:
                    yield Candidate(row, CARD, int(starts[lo]), int(ends[hi - 1]), True)
            elif not passes:
                i = lo
                while i < hi:  # the runs of a chain, or four runs of four digits
                    step = 4 if i + 4 <= hi and all(ends[k] - starts[k] == 4 for k in range(i, i + 4)) else 1
                    if 13 <= total[i + step] - total[i] <= 19:
                        yield Candidate(row, CARD, int(starts[i]), int(ends[i + step - 1]), False)
                    i += step

    def _phones(self):
        plus = np.flatnonzero(self.block.data[:-1] == ord("+")) if len(self.data) else []
        if not len(plus):
            return
        runs = self.block.words(DIAL)
        at = np.searchsorted(runs.starts, plus + 1)
        for p, i in zip(plus.tolist(), at.tolist(), strict=True):
            if i == len(runs.starts) or runs.starts[i] != p + 1 or not DIGIT[self.data[p + 1]]:
                continue
            row = self.row_of(p)
            if p + 1 >= self.block.offsets[row + 1]:
                continue
            body = self.data[p + 1 : runs.ends[i]].rstrip(b" ().-")
            if len(body) >= 3 and 10 <= len(only_digits(body)) <= 15:
                yield Candidate(row, PHONE, p, p + 1 + len(body), True)

    def _dialled(self):
        """Grouped digits without a plus: ``(030) 123-4567``, ``0049 30 1234567``."""
        if not len(self.digits.starts):
            return
        runs = self.block.words(DIAL)
        for lo, hi in zip(runs.starts.tolist(), runs.ends.tolist(), strict=True):
            if hi - lo < 9:
                continue
            body = self.data[lo:hi].rstrip(b" ().-")
            start = lo + len(body) - len(body.lstrip(b" ).-"))
            text = self.data[start : lo + len(body)]
            groups = re.findall(rb"[0-9]+", text)
            if 2 <= len(groups) <= 6 and 9 <= sum(map(len, groups)) <= 15 and len(text) <= 24 and b"  " not in text:
                if max(map(len, groups)) <= 8 and (start == 0 or self.data[start - 1] != ord("+")):
                    yield Candidate(self.row_of(start), PHONE, start, start + len(text), False)

    def _spelled(self):
        if b"dot" not in self.data.lower():
            return
        edges = self.block.offsets.tolist()
        for row, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            for match in _SPELLED.finditer(self.data, lo, hi):
                yield Candidate(row, EMAIL, match.start(), match.end(), False)

    def votes(self, c: Candidate) -> tuple[tuple[int, ...], int, int]:
        """Each labeler's vote (1, 0, -1), the number of digits (20 at most) and the kind of
        separators (none, blanks and dashes, dots, others)."""
        data, body = self.data, self.data[c.start : c.end]
        digits = only_digits(body)
        lo, hi = int(self.block.offsets[c.row]), int(self.block.offsets[c.row + 1])
        groups = [len(g) for g in re.findall(rb"[0-9]+", body)]
        if c.kind == EMAIL:
            last = re.split(rb"[^A-Za-z0-9-]", body.lower())[-1]
            shape = 1 if b"@" in body and b".." not in body else -1
            check = 1 if 2 <= len(last) <= 24 and last.isalpha() else -1
            gazetteer = 1 if last in ENDINGS else 0
            variety = -1 if body.lower().startswith((b"noreply", b"no-reply")) else 1
        else:
            shape = {
                IP: max(groups) <= 3, CARD: groups in ([4, 4, 4, 4], [4, 6, 5]) or groups[0] in (15, 16),
                PHONE: len(groups) >= 2 and max(groups) <= 8,
            }[c.kind] * 2 - 1
            check = {
                IP: all(map(octet, re.findall(rb"[0-9]+", body))), CARD: len(digits) <= 19 and luhn(digits),
                PHONE: 10 <= len(digits) <= 15,
            }[c.kind] * 2 - 1
            gazetteer = {
                IP: not body.startswith((b"0.", b"255.")), CARD: ISSUERS.match(digits) is not None,
                PHONE: CODES.match(body) is not None,
            }[c.kind] * 2 - 1
            variety = 1 if len(set(digits)) > 2 else -1
        before = data[max(lo, c.start - 40) : c.start].lower()
        words = re.findall(rb"[a-z-]+", before)[-4:]
        context = 1 if any(w in CUES[c.kind] for w in words) else -1 if words[-1:] and words[-1] in AGAINST else 0
        edge = -1 if c.start > lo and WORD[data[c.start - 1]] or c.end < hi and WORD[data[c.end]] else 1
        others = set(body) - set(_DIGITS + _LETTERS)
        apart = 0 if not others else 1 if others <= set(b" -") else 2 if others == set(b".") else 3
        return (int(c.strict), shape, check, gazetteer, context, edge, variety), min(len(digits), 20), apart
