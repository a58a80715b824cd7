"""Benchmark decontamination by winnowing.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. Of
each window of ``WINDOW - GRAM + 1`` consecutive ``GRAM``-word hashes the smallest is
kept as a fingerprint, on both sides, so every common run of ``WINDOW`` words has a
fingerprint in common. Fingerprints of documents are joined with those of the items in
each task; each match is then extended word by word as far as a window around it can
reach, and whole windows of the item found there mark their words in the document. A
window that occurs has a fingerprint inside, so nothing beyond that reach is needed.
Fingerprints of one text whose surroundings are equal too are extended once, so words
repeated any number of times on both sides cost what a few of them do.

An item of fewer than ``WINDOW`` words is one window by itself: all runs of its length
are fingerprints then. The items are cut into slices of about ``SLICE_WORDS`` words by a
hash; one slice is broadcast at a time and the document's marks pass on to the next, so
a benchmark of any size is worked through without a shuffle of the documents.

Defined cases: a null text, or one without words, has no words and is never hit; an item
without words is ignored; an item with a null id marks words but is not listed; repeated
documents give equal rows, repeated items are one item, and an id that several items share
is listed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .spans import PLAIN_WORD, TEXT, U64, Block, Words, blocks, fold_texts, gram_starts, grams, ranges
from .store import rewritten

WINDOW = 10
GRAM = 5
SLICE_WORDS = 1 << 21
_BITS = 18
#: Matches that are extended at a time.
STEP = 1 << 15
#: What stands beyond either end of an item and of a text: never equal.
_ITEM_END, _TEXT_END = U64(1), U64(2)


@dataclass
class Slice:
    """Items of one slice: their words one after another and their fingerprints."""

    ids: list[str | None]
    words: np.ndarray
    first: np.ndarray
    need: np.ndarray  # words of a window, by item
    prints: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by window: hash, item, place


def _gram(window: int) -> tuple[int, int]:
    """Words of a fingerprint, and of the window before or behind it."""
    size = GRAM if window == WINDOW else window
    return size, window - size


def _around(
    hashes: np.ndarray, first: np.ndarray, at: np.ndarray, window: int, end: np.integer
) -> tuple[np.ndarray, np.ndarray]:
    """The text of each fingerprint, and the words that a window with it can hold."""
    size, reach = _gram(window)
    text = np.searchsorted(first, at, "right") - 1
    place = at[:, None] + np.arange(-reach, size + reach)
    inside = (place >= first[text][:, None]) & (place < first[text + 1][:, None])
    return text, np.where(inside, hashes[np.clip(place, 0, len(hashes) - 1)], end)


def _alike(text: np.ndarray, near: np.ndarray) -> np.ndarray:
    """One number for fingerprints of a text with equal surroundings."""
    code = text.astype(U64)
    for j in range(near.shape[1]):
        code = (code ^ near[:, j]) * U64(0x9E3779B97F4A7C15)
        code ^= code >> U64(29)
    return code


def winnow(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints that hold for runs of ``window`` words."""
    size, reach = _gram(window)
    codes = grams(hashes, size)
    width = reach + 1
    starts = gram_starts(first, window)
    if not len(starts):
        return starts, np.zeros(0, U64)
    if width == 1:
        return starts, codes[starts]
    least = codes[: len(codes) - width + 1].copy()
    for j in range(1, width):
        np.minimum(least, codes[j : j + len(least)], out=least)
    chosen = np.zeros(len(codes), bool)
    for j in range(width):
        chosen[starts[codes[starts + j] == least[starts]] + j] = True
    at = np.flatnonzero(chosen)
    return at, codes[at]


def _item_rows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """One row per item: id as text, its word hashes, their number."""

    def worker():
        out: list[pa.RecordBatch] = []

        def take(block: Block, batch: pa.RecordBatch) -> None:
            words = block.lower().words(PLAIN_WORD)
            hashes = words.hashes()
            packed = [
                hashes[a:b].tobytes()
                for a, b in zip(words.first[:-1], words.first[1:], strict=True)
            ]
            out.append(
                pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(packed, pa.binary()), pa.array(words.counts, pa.int64())],
                    ["item", "words", "n_words"],
                )
            )

        def give():
            yield from out

        return take, give

    named = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return fold_texts(named, ["item", "text"], "item string, words binary, n_words long", worker)


def _slice(rows: list) -> Slice:
    rows = sorted(rows, key=lambda r: (r["item"] is None, r["item"] or "", bytes(r["words"])))
    hashes = [np.frombuffer(bytes(r["words"]), U64) for r in rows]
    counts = np.array([len(h) for h in hashes], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate(hashes) if hashes else np.zeros(0, U64)
    need = np.minimum(counts, WINDOW)
    prints = {}
    for window in sorted(set(need.tolist())):
        at, codes = winnow(words, first, window)
        owner = np.searchsorted(first, at, "right") - 1
        keep = need[owner] == window
        at, codes = at[keep], codes[keep]
        _, one = np.unique(_alike(*_around(words, first, at, window, _ITEM_END)), return_index=True)
        at, codes = at[one], codes[one]
        order = np.argsort(codes, kind="stable")
        at = at[order]
        prints[window] = (codes[order], np.searchsorted(first, at, "right") - 1, at)
    return Slice([r["item"] for r in rows], words, first, need, prints)


def _extend(
    known: Slice, words: Words, hashes: np.ndarray, hit: np.ndarray
) -> set[tuple[int, int]]:
    """Mark the words of item windows in ``hit``; returns (text, item) pairs."""
    pairs: set[tuple[int, int]] = set()
    for window, (codes, owner, place) in known.prints.items():
        at, own = winnow(hashes, words.first, window)
        if not len(at) or not len(codes):
            continue
        seen = np.zeros(1 << _BITS, bool)
        seen[(codes >> U64(64 - _BITS)).astype(np.int64)] = True
        maybe = seen[(own >> U64(64 - _BITS)).astype(np.int64)]
        at, own = at[maybe], own[maybe]
        known_too = codes[np.minimum(np.searchsorted(codes, own), len(codes) - 1)] == own
        at, own = at[known_too], own[known_too]
        if not len(at):
            continue
        text, near = _around(hashes, words.first, at, window, _TEXT_END)
        _, one, which = np.unique(_alike(text, near), return_index=True, return_inverse=True)
        text, near, own = text[one], near[one], own[one]
        lo = np.searchsorted(codes, own, "left")
        counts = np.searchsorted(codes, own, "right") - lo
        reach = _gram(window)[1]
        found = np.zeros((len(one), reach + 1), bool)
        ends = np.cumsum(counts)
        begin = 0
        while begin < len(one):
            stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] - counts[begin] + STEP)))
            line = np.repeat(np.arange(begin, min(stop, len(one))), counts[begin:stop])
            entry = ranges(lo[begin:stop], counts[begin:stop])
            for part in range(0, len(line), STEP):
                some = slice(part, part + STEP)
                _, theirs = _around(known.words, known.first, place[entry[some]], window, _ITEM_END)
                same = np.zeros((len(theirs), theirs.shape[1] + 1), np.int16)
                np.cumsum(near[line[some]] == theirs, axis=1, out=same[:, 1:])
                row, start = np.nonzero(same[:, window:] - same[:, : reach + 1] == window)
                found[line[some][row], start] = True
                pairs.update(
                    zip(text[line[some][row]].tolist(), owner[entry[some][row]].tolist(), strict=True)
                )
            begin = stop
        row, start = np.nonzero(found[which.ravel()])
        for j in range(window):
            hit[at[row] - reach + start + j] = True
    return pairs


MARKS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.BinaryType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def mark_windows(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """Columns ``keep`` with ``n_words``, ``hit_words`` (a bit per word, the first word in
    the first byte's high bit; null without a hit) and ``hit_items`` (ids as text)."""
    spark = docs.sparkSession
    names = [f.name for f in MARKS]
    keep = [c for c in keep if c not in names]
    rows = _item_rows(items, item_id, item_text).filter("n_words > 0").distinct()
    rows = rewritten(rows, "items")  # every slice reads it
    total = rows.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    slices = max(1, math.ceil(total / slice_words))
    out = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.lit(None).cast("long").alias(names[0]),
        F.lit(None).cast("binary").alias(names[1]),
        F.array().cast("array<string>").alias(names[2]),
        F.col(f"`{text}`").alias(TEXT),
    )
    ship(spark)
    place = F.pmod(F.xxhash64("item", "words"), F.lit(slices))
    for number in range(slices):
        known = _slice(rows.filter(place == number).collect())
        out = _pass(out, spark.sparkContext.broadcast(known))
    return out.drop(TEXT)


def _pass(source: DataFrame, shared) -> DataFrame:
    width = len(source.columns)
    columns = source.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for block in blocks(batch.column(width - 1)):
                own = batch.slice(block.row, block.rows)
                before, listed = own.column(width - 3).to_pylist(), own.column(width - 2).to_pylist()
                words = block.lower().words(PLAIN_WORD)
                hashes = words.hashes()
                hit = np.zeros(len(hashes), bool)
                for text, item in sorted(_extend(known, words, hashes, hit)):
                    if known.ids[item] is not None:
                        listed[text] = [*listed[text], known.ids[item]]
                    marks = hit[words.first[text] : words.first[text + 1]]
                    if before[text] is not None:
                        old = np.frombuffer(before[text], np.uint8)
                        marks = marks | np.unpackbits(old, count=len(marks)).astype(bool)
                    before[text] = np.packbits(marks).tobytes()
                marked = [
                    pa.array(words.counts, pa.int64()),
                    pa.array(before, pa.binary()),
                    pa.array(listed, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[: width - 4], *marked, own.column(width - 1)], columns
                )

    return source.mapInArrow(run, source.schema)


def contamination(
    docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", **options
) -> DataFrame:
    """Columns ``keep`` with the number of words, hit words and items, and the verdict."""
    marked = mark_windows(docs, items, keep, text, **options)
    ids = F.array_sort(F.array_distinct("hit_items"))
    return marked.select(
        *[F.col(f"`{c}`") for c in marked.columns if c not in ("hit_words", "hit_items")],
        F.coalesce(_ones(), F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        F.col("hit_words").isNotNull().alias("contaminated"),
    )


def _ones():
    """The number of one bits of ``hit_words``: hexadecimal digits by their ones."""
    digits = F.translate(F.hex("hit_words"), "0123456789ABCDEF", "0112122312232334")
    return sum(i * (F.length(digits) - F.length(F.replace(digits, F.lit(str(i)), F.lit(""))))
               for i in (1, 2, 3, 4))
