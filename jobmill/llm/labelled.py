"""Bounded samples of labelled documents for classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .spans import U64, Block, fold_texts

FOLDS = 4


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_label: int,
    eligible: Column,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_label`` documents with label 0 and with 1, by the hash of the id.

    Returns rows (label, fold, text) and the number of eligible labels of each kind. The
    chosen ids are at most twice ``per_label``, so they are broadcast to the documents. A
    null label or id is left out; a repeated label row counts once. Of rows that share an id
    the least text counts, so the sample is bounded whatever the number of copies.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.filter("label IN (0, 1) AND id IS NOT NULL").filter(eligible).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.xxhash64(F.lit(label), "id")
    order = Window.partitionBy("label").orderBy("draw", "id")
    chosen = known.withColumn("draw", draw).withColumn("rank", F.row_number().over(order))
    chosen = chosen.filter(F.col("rank") <= per_label)
    chosen = chosen.select("id", "label", F.pmod("draw", F.lit(FOLDS)).cast("int").alias("fold"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(durable(chosen)), "id")
    rows = rows.groupBy("id", "label", "fold").agg(F.min("text").alias("text"))
    return durable(rows.select("label", "fold", "text")), counts


def collect_vectors(
    sample: DataFrame, vectors: Callable[[], Callable[[Block], np.ndarray]], width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, fold, float32 matrix) of a bounded sample, in an order of their own."""

    def worker():
        make = vectors()
        out: list[pa.RecordBatch] = []

        def take(block: Block, batch: pa.RecordBatch) -> None:
            found = make(block).astype(np.float32)
            packed = [zlib.compress(row.tobytes(), 1) for row in found]
            columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary())]
            out.append(pa.RecordBatch.from_arrays(columns, ["label", "fold", "vector"]))

        def give():
            yield from out

        return take, give

    schema = "label int, fold int, vector binary"
    rows = fold_texts(sample, ["label", "fold", "text"], schema, worker).collect()
    rows.sort(key=lambda r: (r["label"], r["fold"], bytes(r["vector"])))
    matrix = np.zeros((len(rows), width), np.float32)
    for i, r in enumerate(rows):
        matrix[i] = np.frombuffer(zlib.decompress(bytes(r["vector"])), np.float32)
    return np.array([r["label"] for r in rows]), np.array([r["fold"] for r in rows]), matrix


def bucket(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashed bins of codes."""
    return (codes % U64(size)).astype(np.int64)
