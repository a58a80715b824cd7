"""Language-model scores: masked pseudo-likelihood of whole texts.

Every word is predicted from ``SIDE`` words on either side. Words fall into ``WORD_BINS``
hashed bins, whose counts come from all documents. The bins are the leaves of a binary tree
built from the counts (the two lightest nodes are joined until one is left), and a word's
probability is the product of the decisions on the way from the root to its leaf, so
probabilities add up to 1 over all bins without a sum over the vocabulary. A decision is a
logistic unit over the hidden layer of a small network: embeddings of the neighbours side
by side and a tanh layer. It starts at the shares of the two branches in the counts.

Nodes with fewer words below than ``LEAST``, or than one of ``SHARE`` words of the corpus,
keep these shares whatever the context; bins as rare share ``SHARED`` embeddings, others have
their own. Tree, decisions and embeddings so grow with the corpus.

Decisions that at least one of ``OFTEN`` words meets lie together at the root. All words of a
batch take them in one matrix product, of which the decisions on a word's path are picked, with
turns (1, -1) by the place where the path leaves them; only what lies below is gathered word
by word.

The network is trained in numpy inside the tasks, once over all documents: every task
starts from the same weights and learns from its own partition block by block. Each row of
weights is averaged over the tasks that met it, by how often they did, slice by slice in
Spark; one set of weights reaches the driver. Weights, and so scores, depend a little on how
the input is split into tasks.

A text's score is the sum of the log-probabilities of all its words. Defined cases: a
null text or one without words has no words and log-probability 0; equal texts score
alike; if no document has words the network stays as it began; bins that no document has
share the place of one word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .labelled import bucket
from .spans import PLAIN_WORD, Block, fold_texts, map_texts, ranges

WORD_BINS = 1 << 20
SLICES = 256
SIDE = 2
WIDTH = 16
LEAST = 4
SHARE = 1 << 16
SHARED = 256
OFTEN = 32
BATCH = 2048
RATE = 0.1
#: Rows of weights that travel together.
ROWS = 2048


def _bins(block: Block) -> tuple[np.ndarray, np.ndarray]:
    words = block.lower().words(PLAIN_WORD)
    return bucket(words.hashes(), WORD_BINS), words.first


def count_bins(docs: DataFrame, text: str) -> np.ndarray:
    """Words per bin over all documents; tasks send the slices that they have seen."""
    width = WORD_BINS // SLICES

    def worker():
        seen = np.zeros(WORD_BINS, np.int64)

        def take(block: Block, batch: pa.RecordBatch) -> None:
            bins, _ = _bins(block)
            np.add.at(seen, bins, 1) if len(bins) < 1024 else np.add(
                seen, np.bincount(bins, minlength=WORD_BINS), out=seen
            )

        def give() -> Iterator[pa.RecordBatch]:
            parts = seen.reshape(SLICES, width)
            numbers = np.flatnonzero(parts.any(axis=1))
            packed = [zlib.compress(parts[i].tobytes(), 1) for i in numbers]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"]
            )

        return take, give

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(counts), np.int64)
                sums[number] = sums[number] + own if number in sums else own
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary()),
            ],
            ["slice", "counts"],
        )

    schema = "slice int, counts binary"
    parts = fold_texts(docs, [text], schema, worker).repartition("slice").mapInArrow(add, schema)
    total = np.zeros(WORD_BINS, np.int64)
    for row in parts.collect():
        at = row["slice"] * width
        total[at : at + width] = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.int64)
    return total


def _joined(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tree over leaves of ascending weights: weight, parent and side of every node, root last."""
    leaves = len(weights)
    total = weights.tolist() + [0] * (leaves - 1)
    parent, side = [0] * len(total), [0] * len(total)
    leaf, inner = 0, leaves
    for new in range(leaves, len(total)):
        for which in (0, 1):
            if leaf < leaves and (inner == new or total[leaf] <= total[inner]):
                child, leaf = leaf, leaf + 1
            else:
                child, inner = inner, inner + 1
            parent[child], side[child] = new, which
            total[new] += total[child]
    parent[-1] = len(total) - 1
    return np.array(total, np.int64), np.array(parent, np.int64), np.array(side, np.int8)


def _turns(
    first: np.ndarray, node: np.ndarray, side: np.ndarray, rare: int, nodes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By group: decisions among the first ``rare`` nodes, and where it leaves the others.

    A path goes from its leaf to the root, so the others are its end, and the lowest of
    them with its side tells them all.
    """
    line = np.repeat(np.arange(len(first) - 1), np.diff(first))
    below = np.bincount(line[node < rare], minlength=len(first) - 1)
    lowest = np.full(len(first) - 1, -1)
    some = below < np.diff(first)
    at = (first[:-1] + below)[some]
    lowest[some] = 2 * node[at] + side[at]
    _, sample, exits = np.unique(lowest, return_index=True, return_inverse=True)
    turns = np.zeros((len(sample), nodes - rare), np.float32)
    for number, group in enumerate(sample):  # at most two exits a node
        path = slice(first[group] + below[group], first[group + 1])
        turns[number, node[path] - rare] = 2.0 * side[path] - 1
    return below, exits.ravel().astype(np.int32), turns


@dataclass
class Vocabulary:
    """Where each bin hangs in the tree, and the embedding it has as a neighbour."""

    group: np.ndarray  # by bin: the branch below the last decision that sees the context
    share: np.ndarray  # by bin: log of its share in that branch
    own: np.ndarray  # by bin: row of its embedding; row 0 is beyond either end of a text
    embeddings: int
    first: np.ndarray  # by group: where its decisions begin
    node: np.ndarray
    side: np.ndarray
    odds: np.ndarray  # by node: log odds of side 1
    below: np.ndarray  # by group: how many of its decisions lie below the often met ones
    exit: np.ndarray  # by group: where its path leaves the often met ones
    turns: np.ndarray  # by exit and often met node, which are the last nodes

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        seen = np.flatnonzero(counts)
        seen = seen[np.argsort(counts[seen], kind="stable")]
        unseen = WORD_BINS - len(seen)
        leaves = np.concatenate([np.ones(min(unseen, 1), np.int64), counts[seen]])
        weight, parent, side = _joined(leaves)
        nodes = np.arange(len(weight))
        least = max(LEAST, int(counts.sum()) // SHARE)
        decides = (nodes >= len(leaves)) & ((weight >= least) | (nodes == len(weight) - 1))
        top = np.where(decides[parent], nodes, parent)
        while not np.array_equal(top, top[top]):
            top = top[top]
        roots, group = np.unique(top[: len(leaves)], return_inverse=True)
        share = np.log(leaves / weight[top[: len(leaves)]])
        number = np.cumsum(decides) - 1
        at, line, met, sides = roots, np.arange(len(roots)), [], []
        while len(at):
            inside = parent[at] != at
            at, line = at[inside], line[inside]
            met.append(np.stack([line, number[parent[at]]]))
            sides.append(side[at])
            at = parent[at]
        lines, node = np.concatenate(met, axis=1)
        order = np.argsort(lines, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(lines, minlength=len(roots)))])
        node, turn = node[order], np.concatenate(sides)[order]
        rare = int(np.searchsorted(weight[decides], -(-int(weight[-1]) // OFTEN)))  # nodes ascend by weight
        below, exits, turns = _turns(first, node, turn, rare, int(decides.sum()))
        right = np.bincount(parent[side == 1], weight[side == 1], len(weight))[decides]
        odds = np.log(right / np.maximum(weight[decides] - right, 1))
        groups, shares = np.zeros(WORD_BINS, np.int32), np.zeros(WORD_BINS, np.float32)
        groups[:], shares[:] = group.ravel()[0], share[0] - np.log(max(unseen, 1))
        groups[seen], shares[seen] = group.ravel()[min(unseen, 1) :], share[min(unseen, 1) :]
        own = 1 + np.arange(WORD_BINS, dtype=np.int32) % SHARED
        often = np.flatnonzero(counts >= least)
        own[often] = 1 + SHARED + np.arange(len(often))
        return cls(
            groups, shares, own, 1 + SHARED + len(often), first.astype(np.int64),
            node.astype(np.int32), turn.astype(np.float32), odds.astype(np.float32), below, exits, turns,
        )


class Network:
    """Rows of ``WIDTH`` weights: embeddings, then the tanh layer, then the decisions.

    The last hidden unit is always 1, so the last weight of a decision is its level.
    """

    def __init__(self, known: Vocabulary, rows: np.ndarray | None = None) -> None:
        self.known = known
        self.inner = known.embeddings
        self.nodes = self.inner + 2 * SIDE * WIDTH + 1
        if rows is None:
            draw = np.random.default_rng(7)
            rows = np.zeros((self.nodes + len(known.odds), WIDTH), np.float32)
            rows[: self.inner] = draw.standard_normal((self.inner, WIDTH)) * 0.3
            rows[self.inner : self.nodes - 1] = draw.standard_normal((2 * SIDE * WIDTH, WIDTH)) * 0.25
            rows[self.nodes :, -1] = known.odds
        self.rows = rows
        deepest = int(np.abs(known.turns).sum(axis=1).max(initial=0))
        #: by exit: the often met decisions on its path, filled up with others, whose turn is 0
        self.path = np.argsort(known.turns == 0, axis=1, kind="stable")[:, :deepest]
        self.turns = np.take_along_axis(known.turns, self.path, axis=1)
        self.on_path = np.abs(known.turns)

    def neighbours(self, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A row per word: the embeddings of the words around it, 0 beyond its text."""
        counts = np.diff(first)
        low, high = np.repeat(first[:-1], counts), np.repeat(first[1:], counts)
        at, own = np.arange(len(bins)), self.known.own[bins]
        columns = []
        for step in (*range(-SIDE, 0), *range(1, SIDE + 1)):
            place = at + step
            inside = (place >= low) & (place < high)
            columns.append(np.where(inside, own[np.clip(place, 0, max(len(bins) - 1, 0))], 0))
        return np.stack(columns, axis=1)

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = self.rows.take(around, axis=0).reshape(len(around), -1)
        out = np.tanh(joined @ self.rows[self.inner : self.nodes - 1] + self.rows[self.nodes - 1])
        out[:, -1] = 1
        return joined, out

    def often(self, hidden: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The often met decisions on the paths: where they stand in a table of words by
        decisions, the turns there, and the log odds of going there."""
        many = self.known.turns.shape[1]
        exits = self.known.exit.take(groups)
        at = self.path.take(exits, axis=0) + many * np.arange(len(groups))[:, None]
        turns = self.turns.take(exits, axis=0)
        return at, turns, turns * (hidden @ self.rows[len(self.rows) - many :].T).ravel().take(at)

    def seldom(self, hidden: np.ndarray, groups: np.ndarray):
        """The decisions below, one of each word at a time: rows of the decisions, sides, weights, log odds.

        The words come with the most such decisions first, so each step has a leading part of them.
        """
        begin, counts = self.known.first.take(groups), self.known.below.take(groups)
        left = np.searchsorted(-counts, -np.arange(counts[0] if len(counts) else 0))
        for step, words in enumerate(left):
            entry = begin[:words] + step
            row = self.nodes + self.known.node.take(entry)
            weights = self.rows.take(row, axis=0)
            yield row, self.known.side.take(entry), weights, np.einsum("ij,ij->i", weights, hidden[:words])

    def longest_first(self, bins: np.ndarray) -> np.ndarray:
        """An order of words that ``seldom`` can take, words of one group side by side."""
        groups = self.known.group.take(bins).astype(np.int64)
        return np.argsort(groups - (self.known.below.take(groups) << 32), kind="stable")

    def log_probability(self, around: np.ndarray, bins: np.ndarray) -> np.ndarray:
        order = self.longest_first(bins)
        _, hidden = self.hidden(around.take(order, axis=0))
        bins = bins.take(order)
        groups = self.known.group.take(bins)
        at, _, right = self.often(hidden, groups)
        on_path = self.on_path.take(self.known.exit.take(groups), axis=0)
        every = np.zeros_like(on_path)  # summed by decision, whatever the length of the path
        every.ravel()[at] = _lost(right)
        lost = np.einsum("ij,ij->i", every, on_path)
        for _, side, _, odds in self.seldom(hidden, groups):
            lost[: len(odds)] += _lost(np.where(side == 1, odds, -odds))
        found = np.empty(len(bins))
        found[order] = self.known.share.take(bins) - lost
        return found


def _put(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Different rows of a table, each written as one value, which is quicker than by weight."""
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(whole).ravel()[rows] = np.ascontiguousarray(values, table.dtype).view(whole).ravel()


def _sums(values: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows. Two weights at a time is quicker; runs of more than four rows would
    then be added up in another order than weight by weight, so these are summed again."""
    sums = np.add.reduceat(values.view(np.complex64), begin, axis=0).view(np.float32)
    many = np.flatnonzero(counts > 4)
    if len(many):
        own = values.take(ranges(begin[many], counts[many]), axis=0)
        sums[many] = np.add.reduceat(own, np.cumsum(counts[many]) - counts[many], axis=0)
    return sums


def _lost(odds: np.ndarray) -> np.ndarray:
    """Minus the log-probability of what has these log odds."""
    return np.maximum(-odds, 0) + np.log(1 + np.exp(-np.abs(odds)))


class Learner:
    """Steps with per-weight rates, and how often each row was met."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.squares = np.full_like(network.rows, 1e-6)
        self.met = np.zeros(len(network.rows), np.float64)

    def _step(self, rows: np.ndarray, slope: np.ndarray) -> None:
        squares = self.squares.take(rows, axis=0)
        squares += slope * slope
        _put(self.squares, rows, squares)
        step = RATE * slope
        step /= np.sqrt(squares, out=squares)
        weights = self.network.rows.take(rows, axis=0)
        weights -= step
        _put(self.network.rows, rows, weights)

    def _scatter(self, rows: np.ndarray, slope: np.ndarray) -> None:
        """A step for each different row, along the sum of its slopes."""
        keys = np.sort(rows.astype(np.int64) << 32 | np.arange(len(rows)))
        ordered = keys >> 32
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        own, counts = ordered[begin], np.diff(np.append(begin, len(ordered)))
        self.met[own] += counts
        self._step(own, _sums(slope.take(keys & 0xFFFFFFFF, axis=0), begin, counts))

    def learn(self, around: np.ndarray, bins: np.ndarray) -> None:
        net = self.network
        if not len(net.known.odds):
            return
        order = net.longest_first(bins)
        around, groups = around.take(order, axis=0), net.known.group.take(bins.take(order))
        joined, hidden = net.hidden(around)
        at, turns, right = net.often(hidden, groups)
        top = np.arange(len(net.rows) - net.known.turns.shape[1], len(net.rows))
        errors = np.zeros((len(groups), len(top)), np.float32)
        errors.ravel()[at] = -turns / (1 + np.exp(np.minimum(right, 30)))
        back = errors @ net.rows[top]
        entries = int(net.known.below.take(groups).sum())
        rows, slopes, at = np.empty(entries, np.int64), np.empty((entries, WIDTH), np.float32), 0
        for row, side, weights, odds in net.seldom(hidden, groups):
            error = (1 / (1 + np.exp(-np.maximum(odds, -30))) - side)[:, None]
            own = slice(at, at + len(row))
            rows[own], at = row, own.stop
            np.multiply(error, hidden[: len(row)], out=slopes[own])
            weights *= error
            back[: len(row)] += weights
        self.met[top] += np.bincount(net.known.exit[groups], minlength=len(net.known.turns)) @ net.on_path
        back *= 1 - hidden * hidden
        inner = net.rows[net.inner : net.nodes - 1]
        into = (back @ inner.T).reshape(-1, WIDTH)
        if entries:
            self._scatter(rows, slopes)
        self._step(top, errors.T @ hidden)
        layer = np.concatenate([joined.T @ back, back.sum(axis=0, keepdims=True)])
        self.met[net.inner : net.nodes] += len(bins)
        self._step(np.arange(net.inner, net.nodes), layer)
        self._scatter(around.ravel(), into)


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> Network:
    """One pass of training inside the tasks; rows averaged by how often tasks met them."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)

    def worker():
        own = Learner(Network(known.value))

        def take(block: Block, batch: pa.RecordBatch) -> None:
            bins, first = _bins(block)
            around = own.network.neighbours(bins, first)
            order = np.random.default_rng(len(bins)).permutation(len(bins))
            for lo in range(0, len(order), BATCH):
                some = order[lo : lo + BATCH]
                own.learn(around.take(some, axis=0), bins.take(some))

        def give() -> Iterator[pa.RecordBatch]:
            for number in range(0, len(own.met), ROWS):
                met = own.met[number : number + ROWS]
                if met.any():
                    sums = (own.network.rows[number : number + ROWS] * met[:, None]).astype(np.float64)
                    yield _packed(number // ROWS, met, sums)

        return take, give

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for number, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.frombuffer(x, np.float64) for x in packed]
                old = found.get(number)
                found[number] = arrays if old is None else [a + b for a, b in zip(old, arrays, strict=True)]
        for number, (met, sums) in sorted(found.items()):
            yield _packed(number, met, sums)

    schema = "slice int, met binary, sums binary"
    parts = fold_texts(docs, [text], schema, worker).repartition("slice").mapInArrow(add, schema)
    network = Network(vocabulary)
    for r in parts.collect():  # one row per slice of the weights
        met = np.frombuffer(bytes(r["met"]), np.float64)
        sums = np.frombuffer(bytes(r["sums"]), np.float64).reshape(len(met), WIDTH)
        at = r["slice"] * ROWS + np.flatnonzero(met)
        network.rows[at] = sums[met > 0] / met[met > 0, None]
    known.unpersist()
    return network


def _packed(number: int, met: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([number], pa.int32()), pa.array([met.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array([sums.tobytes()], pa.binary())], ["slice", "met", "sums"]
    )


FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("log_prob", T.DoubleType()),
        T.StructField("mean_log_prob", T.DoubleType()),
    ]
)


def score(docs: DataFrame, vocabulary: Vocabulary, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``n_words``, ``log_prob`` and its mean per word (0 without words)."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, network.rows))

    def worker():
        own = Network(*shared.value)

        def work(block: Block) -> list[np.ndarray]:
            bins, first = _bins(block)
            around = own.neighbours(bins, first)
            found = np.zeros(len(bins))
            order = own.longest_first(bins)
            for lo in range(0, len(bins), BATCH):
                some = order[lo : lo + BATCH]
                found[some] = own.log_probability(around.take(some, axis=0), bins.take(some))
            sums = np.zeros(block.rows)
            counts = np.diff(first)
            filled = counts > 0
            if filled.any():
                sums[filled] = np.add.reduceat(found, first[:-1][filled])
            return [counts.astype(np.int64), sums, sums / np.maximum(counts, 1)]

        return work

    return map_texts(docs, text, keep, FIELDS, worker)
