"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words (with their weight, their number, the
strongest one), lexicon words near a second-person word, capitals, punctuation and
obfuscation rates (digits inside words, stretched letters, stars between letters), and
length. The lexicon is learned: words and word beginnings (4 to 6 bytes) whose document
frequency among toxic documents stands out by log-odds.

Fitting uses at most ``SAMPLE`` labelled documents of each kind, in four folds by the
hash of the id: two for the lexicon, one for the trees, one for the calibration; with few
labels the trees and the calibration share what there is. Counts of terms come from
Spark, and only terms with enough documents reach the driver, their number bounded by
``MOST_TERMS``, the strongest first. Scoring runs block by block over Arrow batches.

Defined cases: null, empty and wordless texts have all features 0 and get the score of
that; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import FOLDS, collect_vectors, labelled_sample
from .spans import (
    PLAIN_WORD, U64, Block, Words, blocks, byte_table, fold_texts, map_texts, mix, row_sums,
)

SAMPLE = 4000
LEAST_DOCS = 3
LEAST_ODDS = 2.5
MOST_TERMS = 20_000
STEMS = (4, 5, 6)
NEAR = 3
THRESHOLD = 0.3
TREES = 60
DEPTH = 3
RATE = 0.15
CUTS = 32
LEAST_LEAF = 4.0

#: Second-person words of some languages.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros",
)

FEATURES = (
    "weight_density", "hit_density", "hits", "strongest", "second_strongest", "stem_density",
    "near_second_person", "second_person", "capitals", "exclamation", "question", "other_punctuation",
    "digits_inside", "stretched", "stars", "log_words",
)

_PUNCTUATION = byte_table(b".,;:'\"()-/")
_UPPER = byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", high=True)
_DIGIT = byte_table(b"0123456789")
_BITS = 20


def _terms(words: Words) -> list[np.ndarray]:
    """Hash of each word and of its beginnings, 0 where the word is no longer than that."""
    sums = words.block.prefix()
    down = words.block.unshift()
    sizes = words.ends - words.starts
    out = []
    for number, size in enumerate((0, *STEMS)):
        ends = words.ends if not size else np.minimum(words.starts + size, words.ends)
        code = mix((sums[ends] - sums[words.starts]) * down[words.starts] + U64(number << 32))
        out.append(code if not size else np.where(sizes > size, code, U64(0)))
    return out


@dataclass
class Lexicon:
    """Sorted term hashes and their weights, with a coarse table to look up most words."""

    codes: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.codes >> U64(64 - _BITS)).astype(np.int64)] = True

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.float32)
        if not len(self.codes):
            return out
        at = np.flatnonzero(self.maybe[(codes >> U64(64 - _BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        hit = self.codes[place] == codes[at]
        out[at[hit]] = self.weights[place[hit]]
        return out


def _second_person() -> np.ndarray:
    texts = pa.array(list(SECOND_PERSON), pa.large_string())
    return np.sort(np.concatenate([b.words(PLAIN_WORD).hashes() for b in blocks(texts)]))


def features(block: Block, lexicon: Lexicon, persons: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` per text."""
    data, offsets, rows = block.data, block.offsets, block.rows
    words = block.lower().words(PLAIN_WORD)
    n = np.maximum(words.counts, 1)
    chars = np.maximum(np.diff(offsets), 1)
    whole, *stems = _terms(words)
    own = lexicon.look_up(whole)
    begun = np.zeros(len(whole), np.float32)
    for codes in stems:
        np.maximum(begun, lexicon.look_up(codes), out=begun)
    weight = np.maximum(own, begun)
    hit = weight > 0
    plain = words.hashes()
    place = np.minimum(np.searchsorted(persons, plain), len(persons) - 1)
    person = persons[place] == plain if len(plain) else np.zeros(0, bool)
    seen = np.zeros(len(plain) + 1, np.int64)
    np.cumsum(person, out=seen[1:])
    owner = words.owner()
    low = np.maximum(np.arange(len(plain)) - NEAR, words.first[owner] if len(plain) else 0)
    high = np.minimum(np.arange(len(plain)) + NEAR + 1, words.first[owner + 1] if len(plain) else 0)
    near = hit & (seen[high] > seen[low])
    strongest = np.zeros(rows, np.float32)
    np.maximum.at(strongest, owner[hit], weight[hit])
    weaker = np.zeros(rows, np.float32)
    below = hit & (weight < strongest[owner]) if len(plain) else hit
    np.maximum.at(weaker, owner[below], weight[below])
    letter, digit = _LETTER[data], _DIGIT[data]
    middle = np.zeros(len(data), bool)
    middle[1:-1] = letter[:-2] & letter[2:]
    three = np.zeros(len(data), bool)
    three[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
    stars = middle & ~letter & ~digit & ((data == ord("*")) | (data == ord("@")) | (data == ord("$")))
    share = lambda flags: row_sums(flags, offsets) / chars
    per_word = lambda values: row_sums(values, words.first) / n
    return np.column_stack(
        [
            per_word(weight), per_word(hit), row_sums(hit, words.first), strongest, weaker,
            per_word(begun > 0), per_word(near), per_word(person), share(_UPPER[data]),
            share(data == ord("!")), share(data == ord("?")), share(_PUNCTUATION[data]),
            share(middle & digit), share(three), share(stars), np.log1p(words.counts),
        ]
    )


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms that stand out among toxic documents of ``sample`` (label, fold, text)."""

    def worker():
        seen: dict[str, list[np.ndarray]] = {"code": [], "toxic": [], "clean": []}
        totals = np.zeros(2, np.int64)

        def take(block: Block, batch: pa.RecordBatch) -> None:
            toxic = np.array(batch.column(0).to_pylist()) == 1
            totals[:] += [toxic.sum(), (~toxic).sum()]
            words = block.lower().words(PLAIN_WORD)
            owner = words.owner()
            codes = np.concatenate(_terms(words))
            owners = np.tile(owner, len(STEMS) + 1)
            pairs = np.unique(np.stack([owners[codes != 0].astype(U64), codes[codes != 0]]), axis=1)
            bad = toxic[pairs[0].astype(np.int64)] if pairs.size else np.zeros(0, bool)
            order = np.argsort(pairs[1])
            ranked, bad = pairs[1][order], bad[order]
            heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else []
            if len(heads):
                seen["code"].append(ranked[heads].view(np.int64))
                seen["toxic"].append(np.add.reduceat(bad.astype(np.int64), heads))
                seen["clean"].append(np.add.reduceat((~bad).astype(np.int64), heads))

        def give():
            for parts in zip(*seen.values(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts], list(seen))
            if totals.any():  # code 0 carries the numbers of documents
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0]), pa.array(totals[:1]), pa.array(totals[1:])], list(seen)
                )

        return take, give

    parts = fold_texts(sample, ["label", "text"], "code long, toxic long, clean long", worker)
    sums = parts.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = sums.filter(f"code = 0 OR toxic >= {LEAST_DOCS}").orderBy(
        (F.col("code") != 0).asc(), ((F.col("clean") + 0.5) / (F.col("toxic") + 0.5)).asc(), F.desc("toxic"), "code"
    ).limit(MOST_TERMS + 1).collect()
    bad, good = next(((r["toxic"], r["clean"]) for r in rows if r["code"] == 0), (0, 0))
    kept = []
    for r in rows:
        if r["code"]:
            odds = math.log((r["toxic"] + 0.5) / (bad + 1)) - math.log((r["clean"] + 0.5) / (good + 1))
            if odds >= LEAST_ODDS:
                kept.append((r["code"], odds))
    codes = np.array([c for c, _ in kept], np.int64).view(U64)
    order = np.argsort(codes)
    return Lexicon(codes[order], np.array([o for _, o in kept], np.float32)[order])


@dataclass
class Tree:
    """A complete binary tree: feature and cut of each inner node, value of each leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        node = np.zeros(len(matrix), np.int64)
        for _ in range(DEPTH):
            right = matrix[np.arange(len(matrix)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return self.value[node - (2**DEPTH - 1)]


@dataclass
class ToxicityModel:
    """Lexicon, trees and the calibration's steps."""

    lexicon: Lexicon
    trees: list[Tree] = field(default_factory=list)
    start: float = 0.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def raw(self, matrix: np.ndarray) -> np.ndarray:
        return self.start + RATE * sum((t.predict(matrix) for t in self.trees), np.zeros(len(matrix)))

    def score(self, matrix: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(matrix), self.steps, self.levels)


def grow_trees(matrix: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[list[Tree], float]:
    """Boosted trees for the logistic loss, splits at quantiles, second-order leaf values."""
    cuts = [np.unique(np.quantile(matrix[:, j], np.linspace(0, 1, CUTS + 1)[1:-1])) for j in range(matrix.shape[1])]
    bins = np.stack([np.searchsorted(c, matrix[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    mean = np.clip((weight * label).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    start = float(np.log(mean / (1 - mean)))
    raw = np.full(len(matrix), start)
    trees = []
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        slope, bend = weight * (label - p), weight * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(matrix), np.int64)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            best = (1e-9, 0, np.inf)
            if len(at):
                for j, bounds in enumerate(cuts):
                    if not len(bounds):
                        continue
                    g = np.cumsum(np.bincount(bins[at, j], slope[at], len(bounds) + 1))
                    h = np.cumsum(np.bincount(bins[at, j], bend[at], len(bounds) + 1))
                    w = np.cumsum(np.bincount(bins[at, j], weight[at], len(bounds) + 1))
                    gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
                    gain -= g[-1] ** 2 / (h[-1] + 1)
                    gain[(w[:-1] < LEAST_LEAF) | (w[-1] - w[:-1] < LEAST_LEAF)] = -1
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), j, float(bounds[i]))
            feature[k], cut[k] = best[1], best[2]
            right = matrix[at, feature[k]] > cut[k]
            node[at] = 2 * k + 1 + right
        leaf = node - inner
        value = np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + 1)
        trees.append(Tree(feature, cut, value))
        raw += RATE * value[leaf]
    return trees, start


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing steps from scores to probabilities, by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, y, w in zip(score[order], label[order], weight[order], strict=True):
        pools.append([w * y, w, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    steps, levels = [], []
    for total, w, lo, hi in pools:
        p = (total + 0.01) / (w + 0.1)  # no level is quite 0 or 1
        for s in (lo, hi) if hi > lo else (lo,):
            steps.append(s)
            levels.append(p)
    return np.array(steps), np.maximum.accumulate(np.clip(levels, 0, 1))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", eligible: Column | None = None, **names
) -> ToxicityModel | None:
    """Fit on a bounded sample; None without labels of both kinds."""
    eligible = F.lit(True) if eligible is None else eligible
    sample, counts = labelled_sample(docs, labels, label, SAMPLE, eligible, **names)
    if len(counts) < 2:
        return None
    lexicon = learn_lexicon(sample.filter(F.col("fold") >= FOLDS // 2))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def worker():
        known, persons = shared.value, _second_person()
        return lambda block: features(block, known, persons)

    kind, fold, matrix = collect_vectors(sample, worker, len(FEATURES))
    shared.unpersist()
    if len(set(kind.tolist())) < 2:
        return None
    weight = np.ones(len(kind))
    for x in (0, 1):
        weight[kind == x] = counts[x] / max((kind == x).sum(), 1)
    weight *= len(kind) / weight.sum()
    grown, held = fold == 1, fold == 0
    if min((kind[grown] == 1).sum(), (kind[held] == 1).sum()) < 20 or len(set(kind[grown])) < 2:
        grown = held = fold < FOLDS // 2 if len(set(kind[fold < FOLDS // 2])) == 2 else fold >= 0
    model = ToxicityModel(lexicon)
    model.trees, model.start = grow_trees(matrix[grown], kind[grown], weight[grown])
    model.steps, model.levels = isotonic(model.raw(matrix[held]), kind[held], weight[held])
    return model


FIELDS = T.StructType([T.StructField("score", T.DoubleType())])


def toxicity(
    docs: DataFrame, model: ToxicityModel | None, keep: list[str], text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Columns ``keep``, the calibrated ``score`` and ``predicted``, 1 at the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def worker():
        known, persons = shared.value, _second_person()

        def work(block: Block) -> list[np.ndarray]:
            if known is None:
                return [np.zeros(block.rows)]
            return [known.score(features(block, known.lexicon, persons))]

        return work

    found = map_texts(docs, text, [c for c in keep if c != "predicted"], FIELDS, worker)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
