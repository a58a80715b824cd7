"""Arrow text columns as numpy arrays: blocks, words, hashes.

A worker sees a column as blocks of half a MB, so its memory follows the block (or one
longer text), not the batch. All hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

BLOCK_BYTES = 1 << 19
TEXT = "__text"
#: Labels that a sample tells apart, most frequent first.
MOST_LABELS = 256

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_GRAM = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any bits of the result can serve as a bucket."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if size > len(_POWERS.get("up", ())):
        size = max(size, BLOCK_BYTES + BLOCK_BYTES // 4)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def byte_table(chars: bytes, high: bool = False) -> np.ndarray:
    """A 256-entry membership table; ``high`` adds all bytes from 0x80."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    if high:
        table[0x80:] = True
    return table


#: Digits, a-z and everything beyond ASCII: the words of shingles and windows.
PLAIN_WORD = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz", high=True)
#: Everything but space and 0x09-0x0D.
SPACED_WORD = ~byte_table(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Block:
    """Some whole texts of a column: their bytes and where each text begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, row: int):
        self.data, self.offsets, self.row = data, offsets, row
        self.rows = len(offsets) - 1

    def lower(self) -> Block:
        return Block(LOWER[self.data], self.offsets, self.row)

    def words(self, table: np.ndarray) -> Words:
        inside = table[self.data]
        before = np.empty(len(inside) + 1, bool)
        before[0] = False
        before[1:] = inside
        after = before[1:].copy()
        after[:-1] = inside[1:]
        after[-1:] = False
        before = before[:-1]
        first = self.offsets[:-1][np.diff(self.offsets) > 0]
        before[first] = False
        last = self.offsets[1:][np.diff(self.offsets) > 0] - 1
        after[last] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return Words(self, starts, ends)

    def prefix(self) -> np.ndarray:
        """Running sums from which the hash of any byte span follows."""
        up, _ = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_byte_values()[self.data] * up[: len(self.data)], out=sums[1:])
        return sums

    def unshift(self) -> np.ndarray:
        """What brings the running sum from a position down to the first one."""
        return _powers(len(self.data) + 1)[1]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self.prefix()
        return mix((sums[ends] - sums[starts]) * self.unshift()[starts])


class Words:
    """Word spans of a block; ``first[i]:first[i + 1]`` are the words of text ``i``."""

    def __init__(self, block: Block, starts: np.ndarray, ends: np.ndarray):
        self.block, self.starts, self.ends = block, starts, ends
        self.first = np.searchsorted(starts, block.offsets)
        self.counts = np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.block.rows), self.counts)

    def hashes(self) -> np.ndarray:
        return self.block.hashes(self.starts, self.ends)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, also of those that cross texts."""
    if len(hashes) < size:
        return np.zeros(0, U64)
    out = np.zeros(len(hashes) - size + 1, U64)
    for j in range(size):
        out = out * _GRAM + hashes[j : j + len(out)]
    return mix(out)


def gram_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions whose run of ``size`` words stays in its text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], counts)


def ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``begin[i] .. begin[i] + counts[i] - 1`` for all i, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    heads = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(begin - heads, counts)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's values, ``first`` being the row bounds; empty rows give 0."""
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column at texts into blocks of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, bounds, content = column.buffers()
    offsets = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column), row + 4096)
        lo, hi = offsets[row], offsets[end]
        yield Block(data[lo:hi], offsets[row : end + 1] - lo, row)
        row = end


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: T.StructType,
    worker: Callable[[], Callable[[Block], list[np.ndarray]]],
) -> DataFrame:
    """Columns ``keep`` and, per row, what ``worker`` finds in the text's block.

    ``worker`` runs once per task and gives a function from a block to one array per
    field. A kept column with the name of a field gives way to the field.
    """
    keep = [c for c in keep if c not in fields.names]
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(TEXT))
    schema = T.StructType([*source.schema.fields[:-1], *fields.fields])
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else
             pa.int32() if isinstance(f.dataType, T.IntegerType) else
             pa.bool_() if isinstance(f.dataType, T.BooleanType) else
             pa.float64() if isinstance(f.dataType, T.DoubleType) else
             pa.string() if isinstance(f.dataType, T.StringType) else None
             for f in fields.fields]
    names = schema.names
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = worker()
        for batch in batches:
            for block in blocks(batch.column(len(keep))):
                columns = [pa.array(x, k) for x, k in zip(work(block), kinds, strict=True)]
                kept = batch.slice(block.row, block.rows).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names)

    return source.mapInArrow(run, schema)


def fold_texts(
    df: DataFrame,
    columns: list[str],
    schema: str,
    worker: Callable[[], tuple[Callable[[Block, pa.RecordBatch], None], Callable[[], Iterator]]],
) -> DataFrame:
    """Partial results of tasks: ``columns[-1]`` is the text.

    ``worker`` gives two functions: one takes a block and its slice of the batch, the
    other yields the task's record batches when the input is over.
    """
    source = df.select(*[F.col(f"`{c}`") for c in columns])
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, give = worker()
        for batch in batches:
            for block in blocks(batch.column(len(columns) - 1)):
                take(block, batch.slice(block.row, block.rows))
        yield from give()

    return source.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Every fourth document by crc32 of its id as text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, text: str, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` different texts of each label, those with the smallest hashes.

    Equal texts count once, so a hot text has no more weight than another and does not
    thin the others. Returns ``label``, ``text`` and the ``key`` that ordered the choice.
    """
    rows = df.select(F.col(label).alias("label"), F.col(text).alias("text"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("text"))
    copies = rows.groupBy("label", "key").agg(F.count(F.lit(1)).alias("copies"))
    counts = copies.groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("count"))
    share = (F.lit(3.0 * per_label) / F.col("texts")).alias("share")
    most = counts.orderBy(F.desc("count"), "label").limit(MOST_LABELS).select("label", share)
    near = rows.join(F.broadcast(most), "label")
    place = F.col("key").cast("double") / 2.0**64 + 0.5  # of the hash in its range, 0 to 1
    near = near.filter(place <= F.col("share"))
    near = near.groupBy("label", "key").agg(F.min("text").alias("text"))
    order = F.row_number().over(Window.partitionBy("label").orderBy("key", "text"))
    return near.withColumn("rank", order).filter(F.col("rank") <= per_label)
