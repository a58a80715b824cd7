"""Alignment of two tokenizers' tokens over a corpus.

Each text, after one space, is cut into tokens by a byte-level BPE (A) and a piece BPE
(B). Both cover the same bytes, so the tokens of A and B that overlap are linked, and the
positions where both end cut the tokens into groups. How often two ids are linked over the
corpus, as the number of documents that hold the link, tells which id of B stands for an
id of A.

Two passes:

1. every task aligns its documents and sums, per id pair, the documents that hold it.
   The distinct pairs are dealt out by hash into buckets of about ``BUCKET`` keys, and
   every bucket gets a minimal perfect hash and its keys in hash order. A count is then a
   place in the bucket's dense vector: groups of partial sums become dense vectors, which
   are added up as a tree, ``FAN`` at a time. Every key is verified where it is looked up.
2. the documents are aligned again and each link's count is looked up.

The counts of at most ``PAIRS_AT_ONCE`` pairs are broadcast at once. If there are more,
the second pass runs once for each lot of buckets and adds to the same columns, so its
memory does not follow the number of pairs.

A text is aligned unit by unit. A unit ends before a space that follows a character which
is not white space; neither tokenizer has a token across that place (for B this is read
off its pieces, ``cuts_at_spaces``; otherwise a text is one unit). Tasks remember the
alignment of units, at most ``UNITS`` of them. Long texts are walked in segments.

Defined cases: a null or empty text, and one whose tokens of A or B do not give back its
bytes, has no tokens, zeros and empty groups, and counts for no pair. Repeated rows are
documents of their own. An empty table gives an empty result. Kept columns may have any
name except those of the result, which take their place.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .perfect_hash import PerfectHash
from .spans import U64, Block, fold_texts, map_texts, mix, ranges, row_sums
from .store import rewritten

BUCKET = 1 << 17
PAIRS_AT_ONCE = 1 << 22
GROUP_ROWS = 1 << 20
FAN = 16
UNITS = 1 << 19
UNIT_BYTES = 1 << 26
SEGMENT = 1 << 17
LOT = 1 << 15
_LOW = U64(0xFFFFFFFF)

#: How byte-level vocabularies of this family split text (a fixed value of theirs).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Units up to this length go to the encoder by rank, which is quicker on short ones only.
QUICK_CHARS = 256

#: White space up to a word, and further words that no plain space sets apart.
_UNIT = re.compile(r"\s+\S+(?:[^\S ]\s*\S+)*(?:\s+\Z)?|\s+\Z")
#: The same, but a single line feed between words is a unit.
_LINE_UNIT = re.compile(r"\n(?=\S)|\s*\S+(?:(?!\n\S)[^\S ]\s*\S+)*(?:\s+\Z)?|\s+\Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Tokenizers(NamedTuple):
    """Both vocabularies as file contents, so that executors need no files."""

    byte_level: str
    pieces: bytes

    @classmethod
    def read(cls, byte_level: str, pieces: str) -> Tokenizers:
        with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
            return cls(a.read(), b.read())


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: byte values by character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    """What a piece stands for; ``<0xHH>`` is one byte, U+2581 a space."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


def cuts_at_spaces(pieces: list[str]) -> bool:
    """Whether no piece has a space after a character that is not white space."""
    return not any(re.search(r"[^\s▁]▁", p) for p in pieces)


def cuts_at_lines(pieces: list[str]) -> bool:
    """Whether no piece has a line feed, so that it is a byte of its own in every text."""
    return not any("\n" in p for p in pieces)


def merges_in_order(vocabulary: dict) -> bool:
    """Whether a byte-level BPE splits words as its family does and its ids rank its merges,
    so that an encoder by rank gives the same ids."""
    words, model = vocabulary["pre_tokenizer"], vocabulary["model"]
    plain = words["type"] == "ByteLevel" and words.get("use_regex", True) and not words["add_prefix_space"]
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    made = [model["vocab"]["".join(p)] for p in pairs]
    return plain and vocabulary["normalizer"] is None and all(x < y for x, y in pairwise(made))


class Encoder:
    """Both tokenizers, the bytes of every id, and its decimal name before ``,``, ``|`` and ``;``."""

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        stand_in, vocabulary = byte_of_char(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(stand_in[c] for c in token if c in stand_in)
        self.quick = None
        if merges_in_order(json.loads(files.byte_level)):
            ranks = {x: i for i, x in enumerate(self.bytes_a) if x}
            self.quick = tiktoken.Encoding("A", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [piece_bytes(p, self.b.is_byte(i)) for i, p in enumerate(names)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in own]) for own in (self.bytes_a, self.bytes_b))
        self.ids = max(len(self.bytes_a), len(names))
        self.names = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(self.ids)], pa.large_binary())
        self.cuts = cuts_at_spaces(names)
        self.unit = _LINE_UNIT if cuts_at_lines(names) else _UNIT

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B. B puts a space before what it gets: the unit's own if it has
        one; else a line feed keeps it apart, and both go."""
        b = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        return self._ids_a(units), [y if u[0] == " " else y[2:] for u, y in zip(units, b, strict=True)]

    def _ids_a(self, units: list[str]) -> list[list[int]]:
        """Ids of A. No word goes on from a character that is not white space to a space, so
        units that begin and end so are encoded as one text, which is cut at their bytes."""
        short = self.quick is not None
        plain = [short and u[0] == " " and len(u) <= QUICK_CHARS and not u[-1].isspace() for u in units]
        joined = list(compress(units, plain))
        flat = self.quick.encode_ordinary("".join(joined)) if joined else []
        ends = np.cumsum(self.sizes_a[np.array(flat, np.int64)])
        bounds = np.cumsum([len(u.encode()) for u in joined])
        at = np.searchsorted(ends, bounds)
        if len(at) and (at[-1] >= len(ends) or not np.array_equal(ends[at], bounds)):
            return [self._alone(u) for u in units]
        cut = (flat[lo:hi] for lo, hi in pairwise([0, *(at + 1).tolist()]))
        return [next(cut) if p else self._alone(u) for p, u in zip(plain, units, strict=True)]

    def _alone(self, unit: str) -> list[int]:
        if self.quick is not None and len(unit) <= QUICK_CHARS:
            return self.quick.encode_ordinary(unit)
        return self.a.encode(unit, add_special_tokens=False).ids

    def units(self, text: str) -> Iterator[list[str]]:
        """The units of a text, some at a time."""
        whole = " " + text
        if not self.cuts or not text.strip(" "):
            yield [whole]
            return
        begin = 0
        while begin < len(whole):
            cut = _CUT.search(whole, begin + SEGMENT) if len(whole) - begin > SEGMENT else None
            end = cut.start() if cut else len(whole)
            yield self.unit.findall(whole, begin, end)
            begin = end


class Units:
    """The units that a task has met: their tokens, groups and links."""

    def __init__(self, encoder: Encoder, texts: bool):
        self.encoder, self.texts = encoder, texts
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []  # of each unit, as text, if wanted
        self.bad: set[int] = set()  # whose tokens do not give back their bytes
        self.size = 0
        self.pair_of: dict[int, int] = {}  # numbers of pair keys
        self.keys = np.zeros(0, U64)
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.links = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def full(self) -> bool:
        return len(self.known) > UNITS or self.size > UNIT_BYTES

    def numbers(self, units: list[str]) -> list[int]:
        known = self.known
        return [known[u] for u in units]

    def good(self, numbers: list[int]) -> bool:
        return not self.bad or self.bad.isdisjoint(numbers)

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of the given units, one after another, and how many each has."""
        counts = self.first[numbers + 1] - self.first[numbers]
        return self.links[ranges(self.first[numbers], counts)], counts

    def learn(self, lot: list[tuple[int, list[str]]]) -> None:
        """Align the units that were not met before, all at once."""
        known = self.known
        new = list(dict.fromkeys(u for _, own in lot for u in own if u not in known))
        if not new:
            return
        at = len(known)
        known.update(zip(new, range(at, at + len(new)), strict=True))
        ids = self.encoder.encode(new)
        whole = [u.encode() for u in new]
        sides = self._sides(ids, whole)
        if sides is None:
            own = (self.encoder.bytes_a, self.encoder.bytes_b)
            for i, w in enumerate(whole):
                if any(b"".join(map(x.__getitem__, t[i])) != w for t, x in zip(ids, own, strict=True)):
                    self.bad.add(at + i)
                    ids[0][i], ids[1][i], whole[i] = [], [], b""
            sides = self._sides(ids, whole)
        counts, links = self._aligned(*sides)
        self.counts = np.concatenate([self.counts, counts])
        self.links = np.concatenate([self.links, links])
        self.first = np.concatenate([[0], np.cumsum(self.counts[:, 3])])
        self.size += 2 * sum(map(len, new))

    def _sides(self, ids: tuple[list[list[int]], list[list[int]]], whole: list[bytes]):
        """Bounds of units, and of A and B: ids, ends of tokens, tokens per unit; all units
        lie one after another. None if the tokens are not the bytes of every unit."""
        encoder, bounds, text = self.encoder, np.cumsum([len(w) for w in whole]), b"".join(whole)
        sides = []
        for own, sizes, parts in ((encoder.bytes_a, encoder.sizes_a, ids[0]), (encoder.bytes_b, encoder.sizes_b, ids[1])):
            flat, counts = list(chain.from_iterable(parts)), np.array([len(p) for p in parts])
            numbers = np.array(flat, np.int64)
            ends = np.cumsum(sizes[numbers])
            at = np.concatenate([[0], ends])[np.cumsum(counts)]
            if not np.array_equal(at, bounds) or b"".join(map(own.__getitem__, flat)) != text:
                return None
            sides.append((numbers, ends, counts))
        return bounds, *sides

    def _aligned(self, bounds: np.ndarray, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of A, of B, groups, links) per unit, and the pair numbers of all links.

        From one end of a token to the next there is one token of either side, and these
        two overlap.
        """
        (ids_a, ends_a, many_a), (ids_b, ends_b, many_b) = a, b
        merged = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = merged[1:] == merged[:-1]
        ends, cuts = merged[1:][again], merged[np.concatenate([[True], ~again])] if len(merged) else merged
        groups, links = (np.bincount(np.searchsorted(bounds, x), minlength=len(bounds)) for x in (ends, cuts))
        pairs = (ids_a[np.searchsorted(ends_a, cuts)] << 32) | ids_b[np.searchsorted(ends_b, cuts)]
        order = np.argsort(pairs, kind="stable")
        fresh = np.concatenate([[True], np.diff(pairs[order]) != 0])[: len(pairs)]
        distinct, pair_of, keys = pairs[order][fresh].tolist(), self.pair_of, []
        for key in distinct:
            if key not in pair_of:
                pair_of[key] = len(self.keys) + len(keys)
                keys.append(key)
        self.keys = np.concatenate([self.keys, np.array(keys, U64)])
        numbers = np.empty(len(pairs), np.int64)
        numbers[order] = np.array([pair_of[k] for k in distinct], np.int64)[np.cumsum(fresh) - 1]
        if self.texts:
            self._write(ids_a, ids_b, ends_a, ends_b, ends, groups)
        return np.column_stack([many_a, many_b, groups, links]), numbers

    def _write(self, ids_a, ids_b, ends_a, ends_b, ends: np.ndarray, groups: np.ndarray) -> None:
        """The groups of each unit as text: the names of all their ids, A's of a group before
        B's, each with what follows it; one table has them all, so one take joins them."""
        if not len(ids_a):  # no unit of the lot gives back its bytes
            self.groups.extend([b""] * len(groups))
            return
        ids, last = self.encoder.ids, None
        to_a, to_b = (np.searchsorted(x, ends, "right") for x in (ends_a, ends_b))
        name = np.empty(len(ids_a) + len(ids_b), np.int64)
        for own, to, other, mark in ((ids_a, to_a, np.concatenate([[0], to_b])[: len(to_b)], 1), (ids_b, to_b, to_a, 2)):
            many = np.diff(to, prepend=0)
            marks = np.zeros(len(own), np.int64)
            marks[to - 1] = mark
            place = np.arange(len(own)) + np.repeat(other, many)
            name[place] = own + marks * ids
            last = place[to - 1]
        joined = self.encoder.names.take(pa.array(name))
        edges, text = joined.buffers()[1:]
        at = np.frombuffer(edges, np.int64)[np.concatenate([[0], last + 1])[np.concatenate([[0], np.cumsum(groups)])]].tolist()
        text = text.to_pybytes()
        self.groups.extend([text[lo : max(lo, hi - 1)] for lo, hi in pairwise(at)])
        self.size += len(text)


def _texts(block: Block) -> Iterator[str]:
    data, edges = block.data.tobytes(), block.offsets.tolist()
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield data[lo:hi].decode()


_ENCODERS: dict[int, Encoder] = {}


def _encoder(files: Broadcast) -> Encoder:
    """One per worker process; a later application's files replace the earlier ones."""
    key = hash(files.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(files.value)
    return _ENCODERS[key]


def _lots_of_units(block: Block, encoder: Encoder) -> Iterator[list[tuple[int, list[str]]]]:
    """(row, units) of all texts that are not empty, about ``LOT`` units at a time."""
    lot, size = [], 0
    for row, text in enumerate(_texts(block)):
        for own in encoder.units(text) if text else ():
            lot.append((row, own))
            size += len(own)
            if size >= LOT:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def pair_documents(docs: DataFrame, text: str, files: Broadcast) -> DataFrame:
    """(key, spread, documents): partial sums over tasks of the documents that hold a pair."""

    def worker():
        units = Units(_encoder(files), texts=False)
        rows: list[np.ndarray] = []  # the distinct units of each document
        seen = np.zeros(0, np.int64)
        done: list[pa.RecordBatch] = []

        def give_out(keys: np.ndarray, documents: np.ndarray) -> None:
            columns = [pa.array(x.astype(np.int64)) for x in (keys, _spread(keys), documents)]
            done.append(pa.RecordBatch.from_arrays(columns, ["key", "spread", "documents"]))

        def settle() -> None:
            nonlocal seen
            if rows:
                links, counts = units.links_of(np.concatenate(rows))
                own = np.arange(len(rows)).repeat([len(r) for r in rows]).repeat(counts)
                pairs = len(units.keys)
                held = np.sort(own * pairs + links)
                held = held[np.concatenate([[True], np.diff(held) != 0])]
                found = np.bincount(held % pairs, minlength=pairs)
                found[: len(seen)] += seen
                seen = found
                rows.clear()

        def flush() -> None:
            nonlocal seen
            used = np.flatnonzero(seen)
            give_out(units.keys[used], seen[used])
            seen = np.zeros(0, np.int64)
            units.clear()

        def keys_of(parts: list[np.ndarray]) -> np.ndarray:
            links, _ = units.links_of(np.unique(np.concatenate(parts)))
            return units.keys[np.unique(links)]

        def close(parts: list[np.ndarray], aside: list[np.ndarray]) -> None:
            if aside:
                keys = np.unique(np.concatenate(aside + ([keys_of(parts)] if parts else [])))
                give_out(keys, np.ones(len(keys), np.int64))
            elif parts:
                rows.append(parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)))

        def take(block: Block, batch: pa.RecordBatch) -> None:
            open_row, good, parts, aside = -1, False, [], []
            for lot in _lots_of_units(block, units.encoder):
                units.learn(lot)
                for row, own in lot:
                    if row != open_row:
                        if good:
                            close(parts, aside)
                        open_row, good, parts, aside = row, True, [], []
                    numbers = units.numbers(own)
                    good = good and units.good(numbers)
                    parts.append(np.array(list(set(numbers)), np.int64))
                if units.full():  # what the open document holds so far is kept as keys
                    aside.append(keys_of(parts))
                    parts = []
                    settle()
                    flush()
            if good:
                close(parts, aside)
            settle()

        def give():
            flush()
            yield from done

        return take, give

    return fold_texts(docs, [text], "key long, spread long, documents long", worker)


def _spread(keys: np.ndarray) -> np.ndarray:
    """31 well-mixed bits of every key, from which its bucket follows."""
    return (mix(keys) >> U64(33)).astype(np.int64)


def _hashed(keys: DataFrame) -> DataFrame:
    """Per bucket: its perfect hash and its keys in the order of their index."""

    def build(group: pa.Table) -> pa.Table:
        own = group.column("key").to_numpy().view(U64)
        found = PerfectHash.build(own)
        order = np.empty(len(own), U64)
        order[found.index(own)] = own
        columns = [group.column("bucket").slice(0, 1), pa.array([found.tobytes()]), pa.array([order.tobytes()])]
        return pa.Table.from_arrays(columns, ["bucket", "hash", "keys"])

    return keys.groupBy("bucket").applyInArrow(build, "bucket long, hash binary, keys binary")


def _dense(partial: DataFrame, hashed: DataFrame) -> DataFrame:
    """Groups of partial sums as dense vectors over the indices of their bucket."""

    def count(ours: pa.Table, hashes: pa.Table) -> pa.Table:
        own = ours.column("key").to_numpy().view(U64)
        function = PerfectHash.frombytes(hashes.column("hash")[0].as_py())
        known = np.frombuffer(hashes.column("keys")[0].as_py(), U64)
        at = function.index(own)
        if not (known[at] == own).all():
            raise ValueError("a pair is not where its hash points to")
        vector = np.bincount(at, ours.column("documents").to_numpy().astype(float), len(known)).astype(np.int64)
        columns = [hashes.column("bucket").slice(0, 1), hashes.column("part").slice(0, 1), pa.array([vector.tobytes()])]
        return pa.Table.from_arrays(columns, ["bucket", "part", "vector"])

    left, right = partial.groupBy("bucket", "part"), hashed.groupBy("bucket", "part")
    return left.cogroup(right).applyInArrow(count, "bucket long, part long, vector binary")


def _added(vectors: DataFrame, parts: int) -> DataFrame:
    """One dense vector per bucket: vectors are added up as a tree."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int64) for v in group.column("vector"))
        columns = [group.column("bucket").slice(0, 1), group.column("part").slice(0, 1), pa.array([total.tobytes()])]
        return pa.Table.from_arrays(columns, ["bucket", "part", "vector"])

    while parts > 1:
        parts = -(-parts // FAN)
        up = vectors.withColumn("part", F.expr(f"part div {FAN}"))
        vectors = up.groupBy("bucket", "part").applyInArrow(add, "bucket long, part long, vector binary")
    return vectors.select("bucket", "vector")


def count_pairs(partial: DataFrame) -> DataFrame:
    """(bucket, hash, keys, vector): documents per pair, by perfect hash."""
    size = partial.agg(F.count(F.lit(1)), F.count_distinct("key")).first()
    buckets = max(1, -(-size[1] // BUCKET))
    parts = max(1, -(-size[0] // (buckets * GROUP_ROWS)))
    dealt = partial.select((F.col("spread") % buckets).alias("bucket"), "key", "documents")
    hashed = rewritten(_hashed(dealt.select("bucket", "key").distinct()), "hashes")
    part = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("part")
    spread = hashed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    vectors = _added(_dense(dealt.select("*", part), spread), parts)
    return rewritten(hashed.join(vectors, "bucket"), "counts")


def pair_table(counts: DataFrame) -> DataFrame:
    """(a_id, b_id, documents): every linked pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, vector in zip(batch.column(0), batch.column(1), strict=True):
                key = np.frombuffer(keys.as_py(), U64)
                columns = [(key >> U64(32)).astype(np.int32), (key & _LOW).astype(np.int32), np.frombuffer(vector.as_py(), np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a_id", "b_id", "documents"])

    return counts.select("keys", "vector").mapInArrow(run, "a_id int, b_id int, documents long")


class Lookup:
    """Counts of a lot of buckets, and the highest count of every id of A."""

    def __init__(self, buckets: int, rows: list[tuple[int, bytes, bytes, bytes]], best: np.ndarray):
        self.buckets, self.rows, self.best = buckets, rows, best

    def open(self) -> Lookup:
        self.parts = {
            b: (PerfectHash.frombytes(h), np.frombuffer(k, U64), np.frombuffer(v, np.int64))
            for b, h, k, v in self.rows
        }
        return self

    def counts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents per pair, 0 for pairs of other lots; and whether no pair of its A id has more."""
        out = np.zeros(len(keys), np.int64)
        buckets = _spread(keys) % self.buckets
        for bucket in np.unique(buckets).tolist():
            if bucket in self.parts:
                function, known, vector = self.parts[bucket]
                own = np.flatnonzero(buckets == bucket)
                at = function.index(keys[own])
                held = (at >= 0) & (known[np.maximum(at, 0)] == keys[own])
                out[own[held]] = vector[at[held]]
        best = self.best[(keys >> U64(32)).astype(np.int64)]
        return out, (out > 0) & (out == best)


def _lots(counts: DataFrame) -> Iterator[Lookup]:
    """The counted buckets in lots of at most ``PAIRS_AT_ONCE`` pairs, or one bucket."""
    best = pair_table(counts).groupBy("a_id").agg(F.max("documents")).collect()  # at most A's vocabulary
    highest = np.zeros(max([r[0] for r in best], default=0) + 1, np.int64)
    for a_id, documents in best:
        highest[a_id] = documents
    sizes = sorted(counts.select("bucket", F.expr("length(keys) div 8")).collect())
    buckets, begin = len(sizes), 0
    while begin < buckets or begin == 0:
        end, pairs = begin, 0
        while end < buckets and (end == begin or pairs + sizes[end][1] <= PAIRS_AT_ONCE):
            pairs, end = pairs + sizes[end][1], end + 1
        own = counts.filter(F.col("bucket").between(begin, end - 1)).select("bucket", "hash", "keys", "vector")
        yield Lookup(max(1, buckets), [(r[0], *map(bytes, r[1:])) for r in own.toLocalIterator()], highest)
        begin = max(end, 1)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _looked_up(docs: DataFrame, keep: list[str], files: Broadcast, lookup: Broadcast) -> DataFrame:
    """Columns ``keep``, the numbers of every text and the hash of its groups."""
    fields = T.StructType([*[T.StructField(n, T.LongType()) for n in NUMBERS], T.StructField("groups_sha256", T.StringType())])

    def worker():
        units, found = Units(_encoder(files), texts=True), lookup.value.open()
        of_pair = np.zeros((0, 2), np.int64)  # whether it is the best of its A id, and its count

        def sums(parts: list[tuple[int, list[int]]], out: np.ndarray) -> None:
            nonlocal of_pair
            documents, best = found.counts(units.keys[len(of_pair) :])
            of_pair = np.concatenate([of_pair, np.stack([best, documents], axis=1)])
            used, place = np.unique(np.concatenate([p for _, p in parts]), return_inverse=True)
            links, many = units.links_of(used)
            edges = np.concatenate([[0], np.cumsum(many)])
            looked_up = [row_sums(of_pair[links, k], edges).astype(np.int64) for k in (0, 1)]
            per_unit = np.column_stack([units.counts[used], *looked_up])
            starts = np.cumsum([0] + [len(p) for _, p in parts[:-1]])
            np.add.at(out, [row for row, _ in parts], np.add.reduceat(per_unit[place], starts))

        def work(block: Block) -> list[np.ndarray]:
            nonlocal of_pair
            out, bad = np.zeros((block.rows, len(NUMBERS)), np.int64), set()
            digests = {}
            for lot in _lots_of_units(block, units.encoder):
                units.learn(lot)
                parts = []
                for row, own in lot:
                    numbers = units.numbers(own)
                    parts.append((row, numbers))
                    if not units.good(numbers):
                        bad.add(row)
                    if row in digests:
                        digests[row].update(b";")
                    else:
                        digests[row] = hashlib.sha256()
                    digests[row].update(b";".join([units.groups[n] for n in numbers]))
                sums(parts, out)
                if units.full():
                    units.clear()
                    of_pair = of_pair[:0]
            out[list(bad)] = 0
            texts = [digests[r].hexdigest() if r in digests and r not in bad else "" for r in range(block.rows)]
            return [*out.T, texts]

        return work

    return map_texts(docs, "text", keep, fields, worker)


def align(docs: DataFrame, keep: list[str], files: Tokenizers, text: str = "text") -> DataFrame:
    """Columns ``keep`` and per document the numbers of its alignment (``NUMBERS``) and
    ``groups_sha256``, the hash of its groups (``a1,a2|b1;a3|b2``), empty without tokens."""
    context = docs.sparkSession.sparkContext
    ship(docs.sparkSession)
    shared = context.broadcast(files)
    counts = count_pairs(rewritten(pair_documents(docs, text, shared), "pairs"))
    keep = [c for c in keep if c not in (*NUMBERS, "groups_sha256")]
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    left = docs.select(kept.alias("kept"), F.col(f"`{text}`").alias("text"))
    found = None
    for lookup in _lots(counts):
        if found is None:
            found = _looked_up(left, ["kept", "text"], shared, context.broadcast(lookup))
            whole = [*NUMBERS, "groups_sha256"]
        else:  # links of further buckets, added to the same columns
            before = rewritten(found, "aligned").withColumnsRenamed({"n_best": "best", "count_sum": "sum"})
            rest = [c for c in whole if c not in ("n_best", "count_sum")]
            before = before.withColumn("so_far", F.struct(*rest, "best", "sum"))
            more = _looked_up(before.select("kept", "text", "so_far"), ["kept", "text", "so_far"], shared, context.broadcast(lookup))
            sums = [(F.col("n_best") + F.col("so_far.best")).alias("n_best"), (F.col("count_sum") + F.col("so_far.sum")).alias("count_sum")]
            found = more.select("kept", "text", *[F.col(f"so_far.{c}").alias(c) for c in rest], *sums)
    return found.select(*[F.col(f"kept.`{c}`") for c in keep], *whole)


def translation(docs: DataFrame, files: Tokenizers, text: str = "text") -> DataFrame:
    """(a_id, b_id, documents): the id of B that most documents link to an id of A; ties
    go to the smaller id of B."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(files)
    table = pair_table(count_pairs(rewritten(pair_documents(docs, text, shared), "pairs")))
    best = F.max(F.struct("documents", -F.col("b_id"))).alias("best")
    return table.groupBy("a_id").agg(best).select(
        "a_id", (-F.col("best.col2")).alias("b_id"), F.col("best.documents").alias("documents")
    )
