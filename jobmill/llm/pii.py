"""Personal data by weak supervision.

Strict rules find e-mail addresses, IP addresses, card and phone numbers. Near misses
(spelled-out addresses, numbers beside a number, phone numbers without a plus) are
candidates besides. Labelers vote on every candidate: regex labelers on the rule and the
shape, a checksum, gazetteers of endings, issuers and calling codes, and context labelers
on the words before and the characters around (``pii_candidates.VOTES``).

1. One pass counts candidates per (kind, votes, shape). There are at most ``MOST_CELLS``
   such cells, whatever the corpus, so they are collected.
2. Expectation-maximisation, per kind, over all counted votes, estimates how often each
   labeler votes how on true and on false candidates, and each vote pattern's probability.
3. These probabilities train the span classifier, a logistic regression over votes,
   number of digits and separators, on all cells with their counts.
4. Another pass finds the spans: strict matches stay, near misses are added whose
   probability reaches ``ADD_FROM`` and whose checksum does not fail.

Defined cases: a null or empty text has no spans; equal rows have equal spans; without
candidates nothing is learned or added. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .pii_candidates import _CHECK, KINDS, VOTES, Candidate, Finder
from .spans import Block, fold_texts, map_texts

ADD_FROM = 0.9
ROUNDS = 60
MOST_CELLS = len(KINDS) * 3 ** len(VOTES) * 21 * 4
RIDGE = 1.0


class Labels(NamedTuple):
    """What expectation-maximisation found for the candidates of a kind."""

    prior: float  # share of true candidates
    votes: np.ndarray  # [labeler, true or false, vote + 1]: probability of the vote, if any


class SpanModel(NamedTuple):
    """The classifier's weights and the labelers' estimated votes by kind."""

    weights: np.ndarray
    labels: dict[int, Labels]


def cells(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, votes, digits, apart, n): candidates per cell; votes as text such as ``+-0``."""

    def worker():
        counts: dict[tuple, int] = {}

        def take(block: Block, batch: pa.RecordBatch) -> None:
            finder = Finder(block)
            strict = finder.strict()
            for c in [*strict, *finder.near(strict)]:
                key = (c.kind, *finder.votes(c))
                counts[key] = counts.get(key, 0) + 1

        def give():
            rows = list(counts)
            columns = [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array(["".join("-0+"[v + 1] for v in r[1]) for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.int32()),
                pa.array([r[3] for r in rows], pa.int32()),
                pa.array([counts[r] for r in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "votes", "digits", "apart", "n"])

        return take, give

    found = fold_texts(docs, [text], "kind int, votes string, digits int, apart int, n long", worker)
    return found.groupBy("kind", "votes", "digits", "apart").agg(F.sum("n").alias("n"))


def reliabilities(votes: np.ndarray, counts: np.ndarray, check: int = _CHECK) -> tuple[Labels, np.ndarray]:
    """Expectation-maximisation over vote patterns, given the truth independent of each other.

    Starts from the share of votes in favour, and from false where the checksum fails, which
    also tells the two sides apart: no truth is known. A labeler that does not vote says nothing either way. One candidate of either
    side per labeler and vote smooths the estimates.
    """
    places = (votes + 1).astype(int)
    belief = np.where(votes[:, check] < 0, 0.05, np.clip(0.5 + votes.mean(axis=1) / 2, 0.05, 0.95))
    for _ in range(ROUNDS):
        mass = np.stack([belief * counts, (1 - belief) * counts])
        prior = (mass[0].sum() + 1) / (counts.sum() + 2)
        table = np.ones((votes.shape[1], 2, 3)) * [1, 0, 1]
        for labeler in range(votes.shape[1]):
            for side in (0, 1):
                table[labeler, side] += np.bincount(places[:, labeler], mass[side], 3) * [1, 0, 1]
        table /= table.sum(axis=2, keepdims=True)
        table[:, :, 1] = 1
        ratio = np.log(prior / (1 - prior)) + sum(
            np.log(table[k, 0, places[:, k]] / table[k, 1, places[:, k]]) for k in range(votes.shape[1])
        )
        belief = 1 / (1 + np.exp(-np.clip(ratio, -30, 30)))
    return Labels(prior, table), belief


def features(kind: int, votes: tuple[int, ...], digits: int, apart: int) -> list[int]:
    """Positions of the features that are 1: of each kind its own."""
    width = 3 * len(VOTES) + 21 + 4 + 1
    own = [3 * i + v + 1 for i, v in enumerate(votes)]
    return [kind * width + f for f in (*own, 3 * len(VOTES) + digits, 3 * len(VOTES) + 21 + apart, width - 1)]


SIZE = len(KINDS) * (3 * len(VOTES) + 21 + 4 + 1)


def probability(weights: np.ndarray, places: list[int]) -> float:
    return float(1 / (1 + np.exp(-np.clip(weights[places].sum(), -30, 30))))


def fitted(x: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Newton steps of a ridge logistic regression on probabilities."""
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (target - p)) - RIDGE * weights
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return weights


def train(docs: DataFrame, text: str = "text") -> SpanModel:
    """Learn from all candidates of a corpus, without labels."""
    rows = sorted(map(tuple, cells(docs, text).collect()))  # at most MOST_CELLS
    labels, x, target, counts = {}, np.zeros((len(rows), SIZE)), np.zeros(len(rows)), np.zeros(len(rows))
    for kind in range(len(KINDS)):
        own = [i for i, r in enumerate(rows) if r[0] == kind]
        if not own:
            continue
        votes = np.array([["-0+".index(v) - 1 for v in rows[i][1]] for i in own])
        counts[own] = [rows[i][4] for i in own]
        labels[kind], target[own] = reliabilities(votes, counts[own])
        for i, v in zip(own, votes.tolist(), strict=True):
            x[i, features(kind, tuple(v), rows[i][2], rows[i][3])] = 1
    return SpanModel(fitted(x, target, counts) if rows else np.zeros(SIZE), labels)


def added(finder: Finder, strict: list[Candidate], weights: np.ndarray) -> list[Candidate]:
    """The near misses that the classifier takes."""
    out = []
    for c in finder.near(strict):
        votes, digits, apart = finder.votes(c)
        if votes[_CHECK] >= 0 and probability(weights, features(c.kind, votes, digits, apart)) >= ADD_FROM:
            out.append(c)
    return out


FIELDS = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField(n, T.StringType()) for n in ("base_spans", "spans")]
)


def _listed(finder: Finder, found: list[Candidate]) -> list[str]:
    """Per text its spans ``kind:start:end`` by start, then kind, comma-joined."""
    own: list[list[tuple[int, int, str]]] = [[] for _ in range(finder.block.rows)]
    for c in found:
        start, end = finder.point(c.row, c.start), finder.point(c.row, c.end)
        own[c.row].append((start, c.kind, f"{KINDS[c.kind]}:{start}:{end}"))
    return [",".join(s for _, _, s in sorted(x)) for x in own]


def find(docs: DataFrame, model: SpanModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, the number of strict matches of each kind (``n_email`` ...), the
    strict spans (``base_spans``) and all spans (``spans``). A kept column with one of
    these names gives way."""
    weights = model.weights
    ship(docs.sparkSession)

    def worker():
        def work(block: Block) -> list:
            finder = Finder(block)
            strict = finder.strict()
            counts = np.zeros((len(KINDS), block.rows), np.int64)
            for c in strict:
                counts[c.kind, c.row] += 1
            return [*counts, _listed(finder, strict), _listed(finder, strict + added(finder, strict, weights))]

        return work

    return map_texts(docs, text, keep, FIELDS, worker)


def masked(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets, ``[email]``; spans that
    begin inside an earlier one are covered by it."""
    out, at = [], 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]
