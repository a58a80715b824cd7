"""Centroid clustering with vectors and centroids cut by dimension.

Vectors become integers, ``floor(scale * x)``, so that every sum below is exact and the
result does not depend on how Spark deals out the rows. The components are cut into
column blocks, and the blocks of about ``CHUNK`` vectors are stored as one packed matrix
per block. A Lloyd round is

1. a task per chunk and column block adds up squared differences to its own slice of the
   centroids, which gives partial distances (vectors x centroids);
2. the blocks of a chunk meet by key, are added up, and the smallest sum is the cluster;
3. the chunk's clusters go back to its column blocks, each task sums the members of every
   cluster over its blocks, and every slice of the centroids is replaced by the floor of
   sum by count, apart from the other slices.

No step needs a whole vector or a whole centroid in one place. A slice of the centroids
is broadcast while all of them take at most ``BROADCAST_BYTES`` (clusters x components x
8, known beforehand); beyond that copies of the slices are shuffled to the blocks.

Defined cases: vectors that are null, have another number of components, or hold a null,
NaN or infinite component are left out. Components beyond 2^27 after scaling raise an
error, as squared distances no longer fit 64 bits. Distance ties go to the smaller
cluster number; an empty cluster keeps its centroid; repeated rows are vectors of their
own. Fewer vectors than clusters give as many clusters as vectors; none give no rows. Kept
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, ship
from .store import rewritten

CHUNK = 1024
BLOCKS = 4
BROADCAST_BYTES = 1 << 26
COPIES = 64
LARGEST = 1 << 27
SLICES = "chunk long, block int, rows binary, matrix binary"
PARTS = "chunk long, rows binary, part binary"
GROUPS = "chunk long, rows array<long>, clusters array<int>, distances array<long>"
SUMS = "block int, cluster int, place int, total long, n long"


class Clusters(NamedTuple):
    """What a clustering returns: the rows with their cluster, and the centroids."""

    members: DataFrame  # kept columns, cluster int, distance long
    centroids: DataFrame  # cluster int, centroid array<long>


def packed(matrix: np.ndarray) -> bytes:
    """A matrix of integers in the narrowest type that holds it; its first byte tells which."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    for size in (1, 2, 4, 8):
        edge = 1 << (8 * size - 1)
        if -edge <= low and high < edge:
            break
    return bytes([size]) + matrix.astype(f"<i{size}").tobytes()


def unpacked(data: bytes, columns: int) -> np.ndarray:
    """What ``packed`` packed, as 64-bit integers."""
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64).reshape(-1, columns)


def whole_vectors(vector: str, size: int, scale: int) -> tuple[Column, Column]:
    """The test for usable vectors, and their integer components."""
    column = F.col(f"`{vector}`")
    far = F.lit(float(LARGEST))
    usable = (F.size(column) == size) & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * scale))
    near = F.forall(column, lambda x: F.abs(x.cast("double") * scale) < far)
    complaint = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling"))
    return F.coalesce(usable, F.lit(False)), F.when(near, scaled.cast("array<int>")).otherwise(complaint)


def _blocks_of(size: int, blocks: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, size, min(blocks, size) + 1).astype(int).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def _slices(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """Vectors as packed column blocks of ``CHUNK`` rows; a chunk is named by its first row."""
    size = bounds[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                names = part.column(0).to_numpy()
                matrix = part.column(1).flatten().to_numpy().reshape(-1, size)
                out = [
                    (names[0], block, names.tobytes() if block == 0 else None, packed(matrix[:, lo:hi]))
                    for block, (lo, hi) in enumerate(bounds)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], k) for i, k in enumerate(_kinds(SLICES))],
                    ["chunk", "block", "rows", "matrix"],
                )

    return rows.select("row", "components").mapInArrow(run, SLICES)


def _kinds(schema: str) -> list[pa.DataType]:
    known = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return [known[field.split(" ")[1]] for field in schema.split(", ")]


def _distances(slices: DataFrame, own: DataFrame, widths: list[int], clusters: int) -> DataFrame:
    """Partial squared distances of every column block to its slice of the centroids."""
    if clusters * sum(widths) * 8 <= BROADCAST_BYTES:
        met = slices.join(F.broadcast(own), "block")
    else:
        copy = F.pmod(F.xxhash64("chunk"), F.lit(COPIES)).alias("copy")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long")))
        spread = own.select("*", copies.alias("copy"))
        met = slices.select("*", copy).join(spread, ["block", "copy"])
    met = met.select("chunk", "block", "rows", "matrix", "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                width = widths[batch.column(1)[i].as_py()]
                x = unpacked(batch.column(3)[i].as_py(), width)
                centroids = batch.column(4)[i].values.to_numpy().reshape(-1, width)
                part = np.empty((len(x), clusters), np.int64)
                for k, centroid in enumerate(centroids):
                    apart = x - centroid
                    part[:, k] = np.einsum("ij,ij->i", apart, apart)
                parts.append(packed(part))
            columns = [batch.column(0), batch.column(2), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "rows", "part"])

    return met.mapInArrow(run, PARTS)


def _nearest(parts: DataFrame, clusters: int) -> DataFrame:
    """Add up the blocks of every chunk and take the nearest centroid of each row."""

    def add(chunk: pa.Table) -> pa.Table:
        total = sum(unpacked(p, clusters) for p in chunk.column("part").to_pylist())
        rows = next(r for r in chunk.column("rows").to_pylist() if r is not None)
        nearest = total.argmin(axis=1)  # the first of equal distances
        found = (np.frombuffer(rows, np.int64), nearest, total[np.arange(len(total)), nearest])
        columns = [pa.array([x], k) for x, k in zip(found, _kinds(GROUPS)[1:], strict=True)]
        names = ["chunk", "rows", "clusters", "distances"]
        return pa.Table.from_arrays([chunk.column("chunk").slice(0, 1), *columns], names)

    return parts.groupBy("chunk").applyInArrow(add, GROUPS)


def _sums(slices: DataFrame, groups: DataFrame, widths: list[int], clusters: int) -> DataFrame:
    """Sum and number of the members of every cluster, per component."""
    met = slices.join(groups.select("chunk", "clusters"), "chunk").select("block", "matrix", "clusters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((clusters, w), np.int64) for w in widths]
        counts = np.zeros((len(widths), clusters), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                x = unpacked(batch.column(1)[i].as_py(), widths[block])
                cluster = batch.column(2)[i].values.to_numpy()
                np.add.at(sums[block], cluster, x)
                counts[block] += np.bincount(cluster, minlength=clusters)
        for block, width in enumerate(widths):
            used = np.flatnonzero(counts[block])
            cells = len(used) * width
            columns = (np.full(cells, block), used.repeat(width), np.tile(np.arange(width), len(used)),
                       sums[block][used].ravel(), counts[block][used].repeat(width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _kinds(SUMS), strict=True)],
                ["block", "cluster", "place", "total", "n"],
            )

    cells = met.mapInArrow(run, SUMS).groupBy("block", "cluster", "place")
    return cells.agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _moved(centroids: DataFrame, sums: DataFrame) -> DataFrame:
    """Every slice after a round: the floor of the mean, or as it was without members."""
    mean = F.expr("(total - pmod(total, n)) div n")
    value = F.coalesce(mean, "value").alias("value")
    return centroids.join(sums, ["block", "cluster", "place"], "left").select("block", "cluster", "place", value)


def _own_slices(centroids: DataFrame) -> DataFrame:
    """One row per column block: its slice of all centroids, cluster after cluster."""
    cells = F.array_sort(F.collect_list(F.struct("cluster", "place", "value")))
    return centroids.groupBy("block").agg(F.transform(cells, lambda x: x["value"]).alias("slice"))


def lloyd(
    vectors: DataFrame,
    keep: list[str],
    seed_order: Column,
    vector: str = "embedding",
    size: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    blocks: int = BLOCKS,
) -> Clusters:
    """Cluster the usable vectors; the ``clusters`` first by ``seed_order`` are the start.

    ``seed_order`` is a column over ``vectors``; its ties, and nulls, which come last, are
    ordered by the components. After ``rounds`` rounds every vector is assigned once more.
    """
    spark = vectors.sparkSession
    ship(spark)
    bounds = _blocks_of(size, blocks)
    widths = [hi - lo for lo, hi in bounds]
    usable, components = whole_vectors(vector, size, scale)
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = vectors.filter(usable).select(
        F.monotonically_increasing_id().alias("row"), kept.alias("kept"),
        seed_order.alias("seed"), components.alias("components"),
    )
    rows = rewritten(rows, "vectors")
    slices = rewritten(_slices(rows, bounds).repartition("block", F.xxhash64("chunk") % COPIES), "slices")

    order = [F.col("seed").asc_nulls_last(), F.col("components")]
    seeds = rows.orderBy(*order).limit(clusters).select("seed", "components")
    seeds = seeds.withColumn("cluster", F.row_number().over(Window.orderBy(*order)) - 1)
    cells = seeds.select("cluster", F.posexplode("components").alias("at", "value"))
    block = sum((F.col("at") >= hi).cast("int") for _, hi in bounds)
    first = F.element_at(F.array(*[F.lit(lo) for lo, _ in bounds]), F.col("block") + 1)
    cells = cells.withColumn("block", block).withColumn("place", F.col("at") - first)
    centroids = durable(cells.select("block", "cluster", "place", F.col("value").cast("long").alias("value")))
    known = centroids.agg(F.count_distinct("cluster")).first()[0]

    groups = None
    for left in range(rounds, -1, -1):
        parts = _distances(slices, _own_slices(centroids), widths, known)
        groups = rewritten(_nearest(parts, known), "groups")
        if left:
            centroids = durable(_moved(centroids, _sums(slices, groups, widths, known)))

    found = groups.select(F.inline(F.arrays_zip("rows", "clusters", "distances")))
    found = found.toDF("row", "cluster", "distance")
    members = rows.join(found, "row").select(*([F.col(f"kept.`{c}`") for c in keep]), "cluster", "distance")
    values = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    centroid = F.transform(values, lambda x: x["value"]).alias("centroid")
    return Clusters(members, centroids.groupBy("cluster").agg(centroid))


def inertia(found: Clusters) -> DataFrame:
    """Members with their cluster's and the whole inertia and the centroid's components.

    There is one row per cluster in what is joined, as bounded as the centroids.
    """
    sums = found.members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = durable(sums.join(found.centroids, "cluster"))
    total = sums.agg(F.sum("cluster_inertia")).first()[0]
    return found.members.join(sums, "cluster").withColumn("inertia", F.lit(total).cast("long"))
