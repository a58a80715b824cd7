"""Approximate vector search over product-quantised codes, re-ranked exactly.

A unit vector is cut into parts of ``PART`` components, and each part becomes the number of
the nearest of at most 256 centroids: one byte a part instead of four bytes a component.
The centroids are fitted on at most ``FIT_ROWS`` vectors, those with the smallest hashes of
their ids; every vector is indexed.

A search scans the codes of all items. A code stands for its centroids in a row, and their
product with a query is a guess at the similarity. The best ``shortlist`` items of each query
by that guess are ranked by the exact similarity. So codes are read whole, but of the vectors
a query reads those of its short list only.

Codes stream past blocks of queries of bounded size, and a block emits its short lists only.
A vector then travels to each block once, with the queries that have it on their list. An
index is two tables (codes, centroids) that can be stored and extended.

Vectors that are zero, hold no number or have another size are left out
(``rejected_vectors`` names them). No items give no results; fewer items than ``shortlist``
make the search exact; copies tie and go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, ship
from .vectors import (
    PAIRS_AT_ONCE, QUERY_BLOCK_BYTES, _best, _Best, _Block, _deal, _ids, _products, _streamed, _unit, _unit_rows, _usable,
)

PART = 4
CENTROIDS = 256
FIT_ROWS = 16_384
FIT_ROUNDS = 12
#: codes that are spelled out at once, and bytes of a block of queries that scans them
CODE_ROWS = 1 << 14
TABLE_BYTES = 32 << 20
#: short list per wanted result
SHORTLIST = 10


class CodeIndex(NamedTuple):
    """Centroids per part and the codes of all items: ``id, code``."""

    centroids: list[np.ndarray]  # of each part: centroids x components
    codes: DataFrame
    dim: int


def _parts(dim: int, part: int) -> list[slice]:
    return [slice(lo, min(lo + part, dim)) for lo in range(0, dim, part)]


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (-2 * x @ centroids.T + (centroids**2).sum(axis=1)).argmin(axis=1)


def fit(sample: np.ndarray, part: int = PART) -> list[np.ndarray]:
    """Centroids of every part by Lloyd's rounds from evenly spaced distinct rows."""
    out = []
    for cut in _parts(sample.shape[1], part):
        own = np.unique(sample[:, cut], axis=0)
        centroids = own[np.unique(np.linspace(0, len(own) - 1, min(CENTROIDS, len(own))).astype(int))]
        for _ in range(FIT_ROUNDS):
            near = _nearest(sample[:, cut], centroids)
            counts = np.bincount(near, minlength=len(centroids))
            for i in range(centroids.shape[1]):
                sums = np.bincount(near, sample[:, cut][:, i], len(centroids))
                centroids[:, i] = np.where(counts > 0, sums / np.maximum(counts, 1), centroids[:, i])
        out.append(centroids)
    return out


def _encoded(items: DataFrame, centroids: list[np.ndarray], dim: int, part: int) -> DataFrame:
    cuts = _parts(dim, part)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = _unit(pdf["vector"])
                codes = np.stack([_nearest(x[:, c], m) for c, m in zip(cuts, centroids, strict=True)], axis=1)
                yield pd.DataFrame({"id": pdf["id"], "code": [row.tobytes() for row in codes.astype(np.uint8)]})

    ship(items.sparkSession)
    return items.mapInPandas(encode, f"id {items.schema['id'].dataType.simpleString()}, code binary")


def build_index(items: DataFrame, dim: int, id: str = "id", vector: str = "embedding", part: int = PART) -> CodeIndex:
    """Fit the centroids and encode every usable item."""
    rows = _usable(items, id, vector, dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").toPandas()
    if sample.empty:
        return CodeIndex([], rows.select("id", F.lit(None).cast("binary").alias("code")), dim)
    centroids = fit(_unit(sample["vector"]), part)
    return CodeIndex(centroids, durable(_encoded(rows, centroids, dim, part)), dim)


def extended(index: CodeIndex, items: DataFrame, id: str = "id", vector: str = "embedding") -> CodeIndex:
    """The index with further items, by the centroids it has."""
    if not index.centroids:
        return build_index(items, index.dim, id, vector)
    part = index.centroids[0].shape[1]
    more = _encoded(_usable(items, id, vector, index.dim), index.centroids, index.dim, part)
    return index._replace(codes=index.codes.unionByName(more))


def write_index(index: CodeIndex, path: str) -> None:
    """Store an index: ``codes`` and ``centroids`` (a row per part and number)."""
    spark = index.codes.sparkSession
    rows = [(p, n, [float(v) for v in c]) for p, m in enumerate(index.centroids) for n, c in enumerate(m)]
    spark.createDataFrame(rows, "part int, number int, centroid array<double>").write.parquet(f"{path}/centroids")
    index.codes.write.parquet(f"{path}/codes")


def read_index(spark: SparkSession, path: str) -> CodeIndex:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("part", "number").collect()  # 256 a part at most
    parts = [[r["centroid"] for r in rows if r["part"] == p] for p in sorted({r["part"] for r in rows})]
    dim = sum(len(p[0]) for p in parts)
    return CodeIndex([np.array(p) for p in parts], spark.read.parquet(f"{path}/codes"), dim)


class _Scan(_Block):
    """Queries that are compared with what codes stand for."""

    def take(self, cell: int, part: pa.RecordBatch) -> None:
        for lo in range(0, part.num_rows, CODE_ROWS):
            super().take(cell, part.slice(lo, CODE_ROWS))


def _shortlists(queries: DataFrame, index: CodeIndex, size: int, skip_self: bool) -> DataFrame:
    """``query_id, item_id``: the best ``size`` items of each query by their codes."""
    dim, centroids = index.dim, index.centroids
    cuts = _parts(dim, centroids[0].shape[1])

    def spelled(part: pa.RecordBatch) -> np.ndarray:
        codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(-1, len(cuts))
        return np.concatenate([m[codes[:, p]] for p, m in enumerate(centroids)], axis=1)

    deal = _deal(queries, dim, 2 * size, TABLE_BYTES)  # codes are small, results are not
    codes = index.codes.filter("id IS NOT NULL").select(F.col("id").alias("item_id"), F.lit(0).alias("cell"), "code")
    found = _streamed(queries, codes, deal, dim, lambda rows: _Scan(rows, size, skip_self, spelled))
    whole = found if deal.groups == 1 else _best(found, size)  # a block cuts what one group gives
    return whole.select("query_id", "item_id")


class _Ranked(_Best):
    """Queries that are compared with the items that ask for them by id (``asked``)."""

    def __init__(self, rows: pd.DataFrame, k: int):
        super().__init__(rows, k)
        self.order = self.ids.argsort(kind="stable")
        self.sorted = self.ids[self.order]

    def take(self, cell: int, part: pa.RecordBatch) -> None:
        ids, blank = _ids(part.column("item_id"))
        vectors = _unit_rows(part, len(self.unit[0]))
        asked, _ = _ids(part.column("asked").flatten())
        item = np.repeat(np.arange(len(ids)), part.column("asked").value_lengths().to_numpy())
        for lo in range(0, len(asked), PAIRS_AT_ONCE):
            cut = slice(lo, lo + PAIRS_AT_ONCE)
            begin, end = (np.searchsorted(self.sorted, asked[cut], side) for side in ("left", "right"))
            times = end - begin  # rows that share an id are all compared
            ends = times.cumsum()
            place = np.arange(ends[-1]) + np.repeat(begin - ends + times, times)
            rows, own = self.order[place], np.repeat(item[cut], times)
            self.hold(rows, _products(self.unit, rows, vectors, own), ids[own], blank[own])


def _reranked(pairs: DataFrame, queries: DataFrame, items: DataFrame, dim: int, k: int) -> DataFrame:
    """The best ``k`` pairs of each query by exact similarity."""
    deal = _deal(queries, dim, k, QUERY_BLOCK_BYTES, scan=False)
    asked = pairs.groupBy(deal.block("query_id").alias("q_block"), "item_id").agg(F.collect_list("query_id").alias("asked"))
    known = items.select(F.col("id").alias("item_id"), "vector", F.lit(0).alias("cell"))
    return _best(_streamed(queries, asked.join(known, "item_id"), deal, dim, lambda rows: _Ranked(rows, k)), k)


def quantized_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    id: str = "id",
    vector: str = "embedding",
    index: CodeIndex | None = None,
    shortlist: int | None = None,
    skip_self: bool = False,
) -> DataFrame:
    """``query_id, item_id, similarity, rank``: about the ``k`` most similar items.

    Similarities and ranks are exact for the items of a short list; what the codes kept
    off the list is missing. ``shortlist`` is ``SHORTLIST * k`` by default.
    """
    asked, known = _usable(queries, id, vector, dim), _usable(items, id, vector, dim)
    index = build_index(items, dim, id, vector) if index is None else index
    if not index.centroids:
        kinds = [x.schema["id"].dataType.simpleString() for x in (asked, known)]
        schema = f"query_id {kinds[0]}, item_id {kinds[1]}, similarity double, rank int"
        return queries.sparkSession.createDataFrame([], schema)
    asked = asked.filter("id IS NOT NULL")
    pairs = _shortlists(asked, index, max(k, shortlist or SHORTLIST * k), skip_self)
    return _reranked(pairs, asked, known, dim, k)


def search_quality(exact: DataFrame, found: DataFrame, items: int, k: int, shortlist: int | None = None) -> DataFrame:
    """One row: exact results, found ones, their share (recall), ``k``, and the share of the
    items' vectors that a query reads."""
    hits = found.select("query_id", "item_id", F.lit(1).alias("_hit"))
    read = min(1.0, (shortlist or SHORTLIST * k) / max(items, 1))
    return exact.join(hits, ["query_id", "item_id"], "left").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count("_hit").alias("found"),
        (F.count("_hit") / F.count(F.lit(1))).alias("recall"),
        F.lit(k).alias("k"),
        F.lit(read).alias("share_read"),
    )
