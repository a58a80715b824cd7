"""Language identification with a string kernel.

A text is the set of its byte n-grams (1 to 3 bytes of letters, ASCII lower-cased,
everything else one blank), hashed into ``BINS`` bins. The kernel of two texts is the
number of common bins over the root of the product of their sizes. A Nyström map over a
few landmark texts turns kernel ridge regression, one language against the rest, into
one matrix product per block of texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any
training row all are ``und``. Equal texts get equal answers; copies count once in
training. Rows with a null label are not learned from. Ties go to the language that
sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from .spans import LOWER, U64, Block, bounded_sample, byte_table, fold_texts, map_texts, mix

BINS = 1 << 15
LANDMARKS = 32
SAMPLE = 1500
RIDGE = 1e-3
UNKNOWN = "und"

_LETTERS = byte_table(b"abcdefghijklmnopqrstuvwxyz", high=True)
_FOLD = np.where(_LETTERS[LOWER], LOWER, ord(" ")).astype(np.uint8)


@dataclass
class LanguageModel:
    """Languages, the landmarks' bins and the coefficients of their kernel values."""

    languages: list[str]
    bins: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray


def presence(block: Block) -> np.ndarray:
    """A row of flags per text: which bins its n-grams fall into."""
    flags = np.zeros((block.rows, BINS), bool)
    n = len(block.data)
    if not n:
        return flags
    data = _FOLD[block.data]
    blank = data == ord(" ")
    lengths = np.diff(block.offsets)
    owner = np.repeat(np.arange(block.rows), lengths)
    left = np.repeat(block.offsets[1:], lengths) - np.arange(n)
    code = np.zeros(n, U64)
    inner = np.zeros(n, bool)  # two blanks in a row
    inner[1:] = blank[1:] & blank[:-1]
    for size in (1, 2, 3):
        m = n - size + 1
        if m <= 0:
            break
        code = code[:m] * U64(256) + data[size - 1 :]
        good = left[:m] >= size
        for j in range(1, size):
            good &= ~inner[j : j + m]
        if size == 1:
            good &= ~blank
        at = np.flatnonzero(good)
        bins = mix(code[at] + U64(size << 40)) % U64(BINS)
        flags[owner[at], bins.astype(np.int64)] = True
    return flags


def _kernel(flags: np.ndarray, model: LanguageModel) -> np.ndarray:
    sizes = np.maximum(flags.sum(axis=1), 1).astype(np.float32)
    common = flags[:, model.bins].astype(np.float32) @ model.landmarks
    return common / np.sqrt(sizes[:, None] * model.sizes[None, :])


def small_blocks(block: Block, rows: int = 256):
    """The block in runs of at most ``rows`` texts."""
    for lo in range(0, block.rows, rows):
        bounds = block.offsets[lo : lo + rows + 1]
        yield Block(block.data[bounds[0] : bounds[-1]], bounds - bounds[0], block.row + lo)


def _flag_rows(sample: DataFrame) -> list[tuple[str, int, str, bytes]]:
    def worker():
        out = []

        def take(block: Block, batch: pa.RecordBatch) -> None:
            lo = 0
            for part in small_blocks(block):
                flags = presence(part)
                for i in range(part.rows):
                    row = batch.slice(lo + i, 1).to_pydict()
                    out.append((row["label"][0], row["key"][0], np.packbits(flags[i]).tobytes()))
                lo += part.rows

        def give():
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x)) for x in zip(*out, strict=True)], ["label", "key", "bits"]
                )

        return take, give

    rows = fold_texts(sample, ["label", "key", "text"], "label string, key long, bits binary", worker)
    return sorted((r["label"], r["key"], bytes(r["bits"])) for r in rows.collect())


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel | None:
    """Fit on at most ``SAMPLE`` different texts per language, by the hash of the text.

    ``LANDMARKS`` of them per language are collected as bit sets; the products of the
    feature map are summed per task, and only those sums reach the driver.
    """
    sample = durable(bounded_sample(docs, text, label, SAMPLE))
    marks = _flag_rows(sample.filter(F.col("rank") <= LANDMARKS))
    if not marks:
        return None
    bits = np.stack([np.unpackbits(np.frombuffer(b, np.uint8))[:BINS] for _, _, b in marks])
    used = np.flatnonzero(bits.any(axis=0))
    model = LanguageModel(
        sorted({x for x, _, _ in marks}),
        used,
        np.ascontiguousarray(bits[:, used].T.astype(np.float32)),
        np.maximum(bits.sum(axis=1), 1).astype(np.float32),
        np.zeros((len(marks), 0)),
    )
    inner = (model.landmarks.T @ model.landmarks) / np.sqrt(np.outer(model.sizes, model.sizes))
    values, vectors = np.linalg.eigh(inner.astype(np.float64))
    good = values > 1e-6 * values.max() if values.max() > 0 else values > 0
    root = vectors[:, good] / np.sqrt(values[good])  # Nyström map: kernel values @ root
    width, classes = root.shape[1] + 1, len(model.languages)
    shared = sample.sparkSession.sparkContext.broadcast((model, root))

    def worker():
        known, base = shared.value
        index = {x: i for i, x in enumerate(known.languages)}
        gram, cross, seen = np.zeros((width, width)), np.zeros((width, classes)), np.zeros(classes)

        def take(block: Block, batch: pa.RecordBatch) -> None:
            owners = np.array([index.get(x, -1) for x in batch.column(0).to_pylist()])
            lo = 0
            for part in small_blocks(block):
                kernel = _kernel(presence(part), known)
                mapped = np.column_stack([kernel @ base, np.ones(part.rows)])
                own = owners[lo : lo + part.rows]
                lo += part.rows
                gram[:] += mapped.T @ mapped
                np.add(cross, mapped.T @ (own[:, None] == np.arange(classes)), out=cross)
                seen[:] += np.bincount(own[own >= 0], minlength=classes)

        def give():
            packed = np.concatenate([gram.ravel(), cross.ravel(), seen])
            yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()])], ["sums"])

        return take, give

    total = np.zeros(width * width + width * classes + classes)
    for row in fold_texts(sample, ["label", "text"], "sums binary", worker).collect():
        total += np.frombuffer(bytes(row["sums"]))
    shared.unpersist()
    gram = total[: width * width].reshape(width, width)
    cross = total[width * width : -classes].reshape(width, classes)
    penalty = RIDGE * max(total[-classes:].sum(), 1.0) * np.eye(width)
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(gram + penalty, cross)
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    model.weights = weights.astype(np.float32)
    return model


FIELDS = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def identify(
    docs: DataFrame, model: LanguageModel | None, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score``, from the whole text alone."""
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    flag = "__lettered"

    def worker():
        known = shared.value

        def work(block: Block) -> list[np.ndarray]:
            names, scores = [], []
            if known is None:
                return [np.full(block.rows, UNKNOWN, object), np.zeros(block.rows)]
            for part in small_blocks(block):
                kernel = _kernel(presence(part), known)
                found = kernel @ known.weights[:-1] + known.weights[-1]
                best = found.argmax(axis=1)
                names.append(np.array(known.languages, object)[best])
                top = np.clip(found[np.arange(part.rows), best], 0, 1)
                scores.append(np.where(np.isfinite(top), top, 0.0).astype(np.float64))
            return [np.concatenate(names), np.concatenate(scores)]

        return work

    out = map_texts(docs.withColumn(flag, lettered), text, [*keep, flag], FIELDS, worker)
    return out.withColumns(
        {
            "lang_pred": F.when(F.col(flag), F.col("lang_pred")).otherwise(F.lit(UNKNOWN)),
            "score": F.when(F.col(flag), F.col("score")).otherwise(F.lit(0.0)),
        }
    ).drop(flag)
