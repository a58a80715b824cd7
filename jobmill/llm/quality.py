"""Quality rules: counts with fixed limits, then a calibrated n-gram classifier.

The classifier is a logistic regression on hashed words and byte trigrams (lower-cased),
each group as the square roots of its shares. It is fitted on at most ``SAMPLE``
labelled documents of each kind, three quarters of them, and its output is turned into a
probability on the last quarter (Platt's sigmoid), moved to the share of good labels
among all. Scoring runs block by block over Arrow batches.

Words are runs without white space. Lines and five-word windows are compared by 64-bit
hashes within one text. Defined cases: a null or empty text has no words and fails the
base rules; without labels of both kinds the rules alone decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import bucket, collect_vectors, labelled_sample
from .language import small_blocks
from .spans import (
    LOWER, SPACED_WORD, U64, Block, Words, byte_table, gram_starts, grams, map_texts, mix, ranges, row_sums,
)

WORD_BINS = 4096
GRAM_BINS = 4096
SAMPLE = 2000
THRESHOLD = 0.5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
WINDOW = 5
STEPS = 150
PENALTY = 1e-4

_SYMBOLS = byte_table(b"#*$%&|<>")


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """What the fixed rules count, a number per text."""
    words = block.words(SPACED_WORD)
    data, offsets = block.data, block.offsets
    inside = SPACED_WORD[data]
    counted = lambda flags: row_sums(flags, offsets).astype(np.int64)
    hashes = words.hashes()
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": counted(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": counted(_SYMBOLS[data]),
        "n_dup_lines": _duplicate_lines(block, inside),
        "n_repeat_words": _repeated_words(words, hashes),
    }


def _duplicate_lines(block: Block, inside: np.ndarray) -> np.ndarray:
    breaks = np.flatnonzero(block.data == ord("\n"))
    starts = np.unique(np.concatenate([block.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(block.data)]
    owner = np.searchsorted(block.offsets, starts, "right") - 1
    ends = np.append(starts[1:], len(block.data))
    seen = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    worded = seen[ends] > seen[starts]
    starts, ends, owner = starts[worded], ends[worded], owner[worded]
    ends = np.where(block.data[ends - 1] == ord("\n"), ends - 1, ends)
    keys = np.stack([owner.astype(U64), block.hashes(starts, ends)], axis=1)
    kept = np.unique(keys, axis=0) if len(keys) else keys
    lines = np.bincount(owner, minlength=block.rows)
    return lines - np.bincount(kept[:, 0].astype(np.int64), minlength=block.rows)


def _repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    at = gram_starts(words.first, WINDOW)
    if not len(at):
        return np.zeros(words.block.rows, np.int64)
    owner = np.searchsorted(words.first, at, "right") - 1
    keys = mix(grams(hashes, WINDOW)[at] + owner.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    covered[ranges(at[twice], np.full(int(twice.sum()), WINDOW))] = True
    return row_sums(covered, words.first).astype(np.int64)


def vectors(block: Block) -> np.ndarray:
    """Hashed word and trigram shares of each text, as square roots."""
    lowered = Block(LOWER[block.data], block.offsets, block.row)
    words = lowered.words(SPACED_WORD)
    bins = bucket(words.hashes(), WORD_BINS)
    flat = np.bincount(words.owner() * WORD_BINS + bins, minlength=block.rows * WORD_BINS)
    left = flat.reshape(block.rows, WORD_BINS) / np.maximum(words.counts, 1)[:, None]
    data = lowered.data.astype(U64)
    at = gram_starts(block.offsets, 3)
    codes = (data[at] << U64(16)) | (data[at + 1] << U64(8)) | data[at + 2] if len(at) else np.zeros(0, U64)
    counts = np.maximum(np.diff(block.offsets) - 2, 0)
    owner = np.repeat(np.arange(block.rows), counts)
    flat = np.bincount(owner * GRAM_BINS + bucket(mix(codes), GRAM_BINS), minlength=block.rows * GRAM_BINS)
    right = flat.reshape(block.rows, GRAM_BINS) / np.maximum(counts, 1)[:, None]
    return np.sqrt(np.concatenate([left, right], axis=1)).astype(np.float32)


@dataclass
class QualityModel:
    """Weights of the bins, and slope and shift of the probability."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, matrix: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * (matrix @ self.weights + self.bias) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _fit(matrix: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by accelerated gradient steps; both kinds weigh equal."""
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    step = 1 / (0.25 * 3 + PENALTY)  # a row has squared length 2, and 1 for the bias
    now = ahead = np.zeros(matrix.shape[1] + 1)
    for i in range(STEPS):
        off = weight * (_sigmoid(matrix @ ahead[:-1].astype(np.float32) + ahead[-1]) - label)
        slope = np.append(matrix.T @ off.astype(np.float32), off.sum()) + PENALTY * np.append(ahead[:-1], 0)
        after = ahead - step * slope
        ahead, now = after + i / (i + 3) * (after - now), after
    return now[:-1].astype(np.float32), float(now[-1])


def platt(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits labels to scores, by Newton steps."""
    a, b = 1.0, 0.0
    high, low = (label == 1).sum(), (label == 0).sum()
    goal = np.where(label == 1, (high + 1) / (high + 2), 1 / (low + 2))
    for _ in range(50):
        p = _sigmoid(a * score + b)
        w = p * (1 - p) + 1e-9
        g = np.array([((p - goal) * score).sum() + 1e-3 * (a - 1), (p - goal).sum()])
        h = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum()]])
        move = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - float(np.clip(move[0], -5, 5)), b - float(np.clip(move[1], -5, 5))
    return a, b


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", eligible: Column | None = None, **names
) -> QualityModel | None:
    """Fit on a bounded sample; None without labels of both kinds."""
    eligible = F.lit(True) if eligible is None else eligible
    sample, counts = labelled_sample(docs, labels, label, SAMPLE, eligible, **names)

    def worker():
        return lambda block: np.concatenate([vectors(x) for x in small_blocks(block)])

    kind, fold, matrix = collect_vectors(sample, worker, WORD_BINS + GRAM_BINS)
    if len(set(kind.tolist())) < 2:
        return None
    rest = fold == 0
    if len(set(kind[~rest].tolist())) < 2 or len(set(kind[rest].tolist())) < 2:
        rest = np.zeros(len(kind), bool)
    weights, bias = _fit(matrix[~rest], kind[~rest])
    used = rest if rest.any() else ~rest
    slope, shift = platt(matrix[used] @ weights + bias, kind[used])
    # The sigmoid holds for the sample's mixture of labels; move it to that of all labels.
    held = (kind[used] == 1).sum() / max((kind[used] == 0).sum(), 1)
    shift += float(np.log(counts[1] / counts[0]) - np.log(held))
    return QualityModel(weights, bias, slope, shift)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = T.StructType(
    [T.StructField(x, T.LongType()) for x in COUNTS] + [T.StructField("quality", T.DoubleType())]
)


def apply_rules(
    docs: DataFrame, model: QualityModel | None, keep: list[str], text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Columns ``keep``, the counts, ``base_failed``, ``quality`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def worker():
        known = shared.value

        def work(block: Block) -> list[np.ndarray]:
            counts = base_counts(block)
            if known is None:
                good = np.ones(block.rows)
            else:
                good = np.concatenate([known.probability(vectors(x)) for x in small_blocks(block)])
            return [*(counts[x] for x in COUNTS), good.astype(np.float64)]

        return work

    keep = [c for c in keep if c not in ("base_failed", "kept")]
    found = map_texts(docs, text, keep, FIELDS, worker)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
