"""Vector search and match scoring over whole tables, without a cross join.

Vectors are scaled to unit length, so a larger cosine is a smaller distance and the
triangle inequality can rule out work. Items are assigned to the nearest of a few pivots;
a query is compared only with the cells that can still hold a result. Queries are cut into
blocks of bounded size. A task keeps the best results of its block while the items stream
past in Arrow batches, so neither a cell that holds a third of all vectors nor the number
of items takes memory, and results leave a task once per query, never all pairs.

In many dimensions nearly all pairs are compared. That is done in single precision first;
only pairs that reach the last result of their query, less the largest error this can have,
are computed in double precision, and only those are held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import GRADE_BOUNDS, grade
from ..session import durable, ship

#: bytes of the pivots, which travel to every task; more are refused
PIVOT_BYTES = 64 << 20
#: bytes of the items that are compared at once and of a block of queries, as doubles; a
#: block meets all items, so larger ones mean fewer copies of the items
ITEM_BLOCK_BYTES = 1 << 20
QUERY_BLOCK_BYTES = 32 << 20
#: queries of a block and results it may hold, and pairs that are compared at once
BLOCK_QUERIES = 1 << 20
BLOCK_RESULTS = 1 << 21
PAIRS_AT_ONCE = 1 << 20
#: queries whose way to the cells is found at once, or that are compared at once
REACH_ROWS = 1024
#: best jobs of a profile that are scored
TOP_JOBS = 200
#: similarities are compared after rounding, so that copies tie exactly
DIGITS = 9
#: slack of distance tests, above the error that rounding can cause
SLACK = 1e-4


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _usable(df: DataFrame, id: str, vector: str, dim: int, *more: str) -> DataFrame:
    length = F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    whole = (F.size(vector) == dim) & (length > 0) & ~F.isnan(length)
    return df.select(F.col(id).alias("id"), F.col(vector).alias("vector"), *more).filter(whole)


def rejected_vectors(df: DataFrame, id: str, vector: str, dim: int) -> DataFrame:
    """``id, reason`` of the rows that a search over ``dim`` dimensions leaves out."""
    length = F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    reason = (
        F.when(F.col(vector).isNull(), "missing")
        .when(F.size(vector) != dim, "size")
        .when(length.isNull() | F.isnan(length), "not a number")
        .when(length == 0, "zero")
    )
    return df.select(F.col(id).alias("id"), reason.alias("reason")).filter("reason IS NOT NULL")


class _Plan(NamedTuple):
    """What a task needs to know of the cells."""

    pivots: np.ndarray
    stats: pd.DataFrame
    near: pd.DataFrame


class _Cells:
    """Items cut into cells, with the statistics that searching them needs."""

    def __init__(self, items: DataFrame, keep: int, pivots: int, dim: int):
        if pivots * dim * 8 > PIVOT_BYTES:
            raise ValueError(f"{pivots} pivots of {dim} dimensions are too many for every task")
        rows = items.orderBy(F.xxhash64(F.col("id")), "id").limit(pivots)
        sample = rows.select("vector").toPandas()
        self.empty = sample.empty
        if self.empty:
            return
        self.pivots = centers = _unit(sample["vector"])
        schema = items.schema
        key_type = schema["id"].dataType.simpleString()

        def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                if len(pdf):
                    d = _distances(_unit(pdf["vector"]), centers)
                    cell = d.argmin(axis=1)
                    yield pdf.assign(cell=cell, radius=d[np.arange(len(pdf)), cell])

        self.items = durable(
            items.mapInPandas(
                assign, f"id {key_type}, vector array<float>, cell int, radius double"
            )
        )
        stats = self.items.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("radius").alias("far")
        )
        # One row per pivot, and at most `keep` radii per pivot.
        self.stats = stats.orderBy("cell").toPandas()
        near = Window.partitionBy("cell").orderBy("radius", "id")
        self.near = (
            self.items.withColumn("_rn", F.row_number().over(near))
            .filter(F.col("_rn") <= keep)
            .select("cell", "radius")
            .toPandas()
        )

    def plan(self) -> _Plan:
        return _Plan(self.pivots, self.stats, self.near)


def _reach(pdf: pd.DataFrame, unit: np.ndarray, cells: _Plan, k: int | None, floor: float | None, probes: int | None) -> np.ndarray:
    """For queries and cells (in the order of ``cells.stats``): can the cell hold a result?"""
    near = cells.near
    d = _distances(unit, cells.pivots)
    to_cell = d[:, cells.stats["cell"].to_numpy()]
    if probes is not None:
        rank = to_cell.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        return rank < probes
    bound = np.full(len(pdf), np.inf)
    if floor is not None:
        bound = np.full(len(pdf), np.sqrt(max(0.0, 2.0 - 2.0 * floor)))
    if k is not None and len(near) >= k:
        # k items are certainly this close: their pivot distance plus radius.
        reach = d[:, near["cell"].to_numpy()] + near["radius"].to_numpy()
        bound = np.minimum(bound, np.partition(reach, k - 1, axis=1)[:, k - 1])
    if "least" in pdf.columns:
        bound = np.minimum(bound, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * pdf["least"].to_numpy())))
    return to_cell - cells.stats["far"].to_numpy() <= bound[:, None] + SLACK


def _visits(
    queries: DataFrame, cells: _Cells, k: int | None, floor: float | None, probes: int | None
) -> DataFrame:
    """One row per query and cell that can hold one of its results."""
    plan = cells.plan()
    own = ["least"] if "least" in queries.columns else []

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for start in range(0, len(pdf), REACH_ROWS):
                part = pdf.iloc[start : start + REACH_ROWS]
                q, c = _reach(part, _unit(part["vector"]), plan, k, floor, probes).nonzero()
                yield pd.DataFrame({"cell": plan.stats["cell"].to_numpy()[c]})

    return queries.select("vector", *own).mapInPandas(visit, "cell int")


def _products(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Rounded products of rows ``i`` of ``a`` with rows ``j`` of ``b``."""
    out, step = np.empty(len(i)), max(1, ITEM_BLOCK_BYTES // (8 * a.shape[1]))
    for lo in range(0, len(i), step):
        cut = slice(lo, lo + step)
        out[cut] = np.einsum("ij,ij->i", a[i[cut]], b[j[cut]])
    return np.round(out, DIGITS)


def _true(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns where a matrix is true; most of it is not, so eight cells are looked
    at together."""
    flat = found.reshape(-1)
    if len(flat) % 8:
        return found.nonzero()
    words = flat.view(np.uint64).nonzero()[0]
    word, cell = flat.reshape(-1, 8)[words].nonzero()
    return np.divmod(words[word] * 8 + cell, found.shape[1])


class _Best:
    """The best results of a block of queries over the items seen so far.

    Rows with one id count as one query here, and share their results.
    """

    def __init__(self, rows: pd.DataFrame, k: int | None):
        self.k, self.ids, self.unit = k, rows["id"].to_numpy(), _unit(rows["vector"])
        _, first, place = np.unique(self.ids, return_index=True, return_inverse=True)
        self.name = first[place].astype(np.int32)  # the first row with the id of a row
        self.least = rows["least"].to_numpy() if "least" in rows.columns else np.full(len(rows), -np.inf)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held, self.limit = 0, 0 if k is None else 2 * max(len(rows) * k, 1)

    def hold(self, rows: np.ndarray, sims: np.ndarray, ids: np.ndarray, blank: np.ndarray) -> None:
        self.parts.append((self.name[rows], sims, ids, blank))
        self.held += len(rows)
        if self.k is not None and self.held > self.limit:
            self.cut()

    def cut(self) -> None:
        """Keep the best ``k`` of each query; what comes later must reach the last of them."""
        parts, self.parts = self.parts, []
        query, sims, ids, blank = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        if self.k is not None and len(query):
            # Query and similarity as one number, with the greater similarity first.
            key = (query.astype(np.int64) << 43) + ((1 << 42) - np.rint(sims * 10**DIGITS).astype(np.int64))
            order = key.argsort()
            key = key[order]
            same = key[1:] == key[:-1]
            if same.any():
                tied = np.r_[False, same] | np.r_[same, False]
                among = order[tied]
                named = pd.factorize(ids[among], sort=True)[0] if ids.dtype == object else ids[among]
                order[tied] = among[np.lexsort((named, blank[among], key[tied]))]
            query = query[order]
            begins = np.r_[True, query[1:] != query[:-1]].nonzero()[0]
            place = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)]))
            del key
            best = place < self.k
            order, query, place = order[best], query[best], place[best]
            sims, ids, blank = sims[order], ids[order], blank[order]
            last, reached = place == self.k - 1, np.full(len(self.ids), -np.inf)
            reached[query[last]] = sims[last]
            self.least = np.maximum(self.least, reached[self.name])
        self.parts, self.held = [(query, sims, ids, blank)], len(query)

    def results(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self.cut()
        query, sims, ids, blank = self.parts[0]
        for lo in range(0, len(query), 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            columns = [
                pa.array(self.ids[query[cut]], schema.field(0).type),
                pa.array(ids[cut], schema.field(1).type, mask=blank[cut]),
                pa.array(sims[cut], schema.field(2).type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


class _Block(_Best):
    """Queries that are compared with all items of the cells they visit."""

    def __init__(
        self,
        rows: pd.DataFrame,
        k: int | None,
        skip_self: bool,
        read: Callable[[pa.RecordBatch], np.ndarray],
        plan: _Plan | None = None,
        floor: float | None = None,
        probes: int | None = None,
    ):
        super().__init__(rows, k)
        self.skip_self, self.read, self.floor = skip_self, read, floor
        self.near = self.unit.astype(np.float32)
        # New pages for every comparison would take a quarter of its time.
        self.guesses, self.marks = np.empty(PAIRS_AT_ONCE, np.float32), np.empty(PAIRS_AT_ONCE, bool)
        # Twice the largest error of a product in single precision.
        self.slack = (self.unit.shape[1] + 8) * 2.0**-23
        self.hit, self.column = None, {}
        if plan is not None:
            cuts = [slice(lo, lo + REACH_ROWS) for lo in range(0, len(rows), REACH_ROWS)]
            self.hit = np.concatenate([_reach(rows.iloc[c], self.unit[c], plan, k, floor, probes) for c in cuts])
            self.column = {int(c): i for i, c in enumerate(plan.stats["cell"])}

    def take(self, cell: int, part: pa.RecordBatch) -> None:
        ids, blank = _ids(part.column("item_id"))
        vectors = self.read(part)
        step = max(1, min(PAIRS_AT_ONCE, ITEM_BLOCK_BYTES // (8 * vectors.shape[1])))
        for start in range(0, len(ids), step):
            cut = slice(start, start + step)
            self.add(cell, ids[cut], blank[cut], vectors[cut])

    def add(self, cell: int, ids: np.ndarray, blank: np.ndarray, vectors: np.ndarray) -> None:
        """Compare the queries that visit the cell with some of its items."""
        visiting = np.arange(len(self.ids)) if self.hit is None else self.hit[:, self.column[cell]].nonzero()[0]
        whole = len(visiting) == len(self.ids)
        near = vectors.astype(np.float32).T
        slack = self.slack * max(1.0, float(np.linalg.norm(vectors, axis=1).max()))
        step = max(1, min(REACH_ROWS, PAIRS_AT_ONCE // len(ids)))
        for start in range(0, len(visiting), step):
            rows = visiting[start : start + step]
            shape = len(rows), len(ids)
            guess, mark = (room[: shape[0] * shape[1]].reshape(shape) for room in (self.guesses, self.marks))
            np.matmul(self.near[start : start + step] if whole else self.near[rows], near, out=guess)
            least = self.least[rows]
            bar = least if self.floor is None else np.maximum(least, self.floor)
            bar = (bar - slack).astype(np.float32)
            fresh = np.isneginf(least).nonzero()[0]
            if len(fresh) and self.k is not None and len(ids) > self.k:
                some = np.where(np.isnan(guess[fresh]), -np.inf, guess[fresh])
                if self.skip_self:
                    some[(self.ids[rows[fresh]][:, None] == ids[None, :]) & ~blank[None, :]] = -np.inf
                last = -np.partition(-some, self.k - 1, axis=1)[:, self.k - 1]
                bar[fresh] = np.maximum(bar[fresh], last - np.float32(slack))
            q, i = _true(np.greater_equal(guess, bar[:, None], out=mark))
            if not len(q):
                continue
            if 16 * len(q) > guess.size:
                sims = np.round((self.unit[rows] @ vectors.T)[q, i], DIGITS)
            else:
                sims = _products(self.unit, rows[q], vectors, i)
            keep = sims >= least[q]
            if self.floor is not None:
                keep &= sims > self.floor
            if self.skip_self:
                keep &= (self.ids[rows[q]] != ids[i]) | blank[i]
            i = i[keep]
            self.hold(rows[q[keep]], sims[keep], ids[i], blank[i])


class _Deal(NamedTuple):
    """Blocks of queries, and groups of items that each block meets one by one."""

    blocks: int
    groups: int

    def block(self, id: str) -> Column:
        return F.pmod(F.xxhash64(id), F.lit(self.blocks)).cast("int")

    def group(self, id: str) -> Column:
        return F.pmod(F.xxhash64(id), F.lit(self.groups)).cast("int")


def _deal(queries: DataFrame, dim: int, k: int | None, query_bytes: int, scan: bool = True) -> _Deal:
    """Blocks of queries after their number. A block that scans finds its lists anew in each
    group, so those are as many as the tasks ask for, and there are groups only beyond that."""
    rows = max(1, min(BLOCK_QUERIES, query_bytes // (8 * dim), BLOCK_RESULTS // k if k else BLOCK_QUERIES))
    tasks, asked = 2 * queries.sparkSession.sparkContext.defaultParallelism, queries.count()
    if scan:
        rows = min(rows, max(REACH_ROWS, -(-asked // tasks)))
    blocks = max(1, -(-asked // rows))
    return _Deal(blocks, max(1, -(-tasks // blocks)))


def _streamed(
    queries: DataFrame, items: DataFrame, deal: _Deal, dim: int, block: Callable[[pd.DataFrame], _Best]
) -> DataFrame:
    """``query_id, item_id, similarity``: the results that blocks of queries hold after the
    items of a group have passed.

    ``queries(id, vector)`` may have ``least``. ``items`` has ``item_id``, ``cell`` (the
    order in which they pass) and what the block reads of them; without ``q_block`` every
    item meets all queries. A task gets one block and one group.
    """
    ship(queries.sparkSession)
    own = ["least"] if "least" in queries.columns else []
    left = queries.select(
        deal.block("id").alias("q_block"), F.explode(F.sequence(F.lit(0), F.lit(deal.groups - 1))).alias("i_group"),
        F.lit(-1).alias("cell"), F.col("id").alias("query_id"), "vector", *own,
    )
    right = items.withColumn("i_group", deal.group("item_id"))
    if "q_block" not in items.columns:
        right = right.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(deal.blocks - 1))))
    met = left.unionByName(right, allowMissingColumns=True)
    tasks, place = deal.blocks * deal.groups, F.col("q_block") * deal.groups + F.col("i_group")
    # By hash some tasks would get several pairs of block and group, and others none.
    dealt = met.repartitionById(tasks, place) if hasattr(met, "repartitionById") else met.repartition(tasks, place)
    met = dealt.sortWithinPartitions("q_block", "i_group", "cell")
    groups = deal.groups

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting, arrow = None, None, [], None
        for batch in batches:
            if arrow is None:
                kinds = [batch.schema.field(c).type for c in ("query_id", "item_id")]
                arrow = pa.schema(zip(["query_id", "item_id", "similarity"], [*kinds, pa.float64()], strict=True))
            place = batch.column("q_block").to_numpy().astype(np.int64) * groups + batch.column("i_group").to_numpy()
            cell = batch.column("cell").to_numpy()
            changes = np.flatnonzero((np.diff(place) != 0) | (np.diff(cell) != 0)) + 1
            for lo, hi in zip([0, *changes], [*changes, len(cell)], strict=True):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if place[lo] != now:
                    if held is not None:
                        yield from held.results(arrow)
                    now, held, waiting = place[lo], None, []
                if cell[lo] < 0:
                    frame = {"id": _ids(part.column("query_id"))[0], "vector": list(_matrix(part, dim))}
                    waiting.append(pd.DataFrame(frame | {c: part.column(c).to_numpy() for c in own}))
                    continue
                if held is None and waiting:
                    held, waiting = block(pd.concat(waiting, ignore_index=True)), []
                if held is not None:
                    held.take(int(cell[lo]), part)
        if held is not None:
            yield from held.results(arrow)

    kinds = [df.schema[c].dataType.simpleString() for df, c in ((queries, "id"), (items, "item_id"))]
    return met.mapInArrow(compare, f"query_id {kinds[0]}, item_id {kinds[1]}, similarity double")


def _unit_rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    vectors = _matrix(batch, dim).astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _search(
    queries: DataFrame,
    items: DataFrame,
    dim: int,
    k: int | None = None,
    floor: float | None = None,
    probes: int | None = None,
    pivots: int = 64,
    skip_self: bool = False,
    tally: dict[str, int] | None = None,
) -> DataFrame:
    """``query_id, item_id, similarity``: the best ``k``, those above ``floor``, or both.

    A column ``least`` of the queries is a similarity of its own that each one's results
    must reach. ``tally`` gets the number of pairs that are compared at most.

    A task holds a block of queries while the items of a group stream past it, cell by
    cell, and hands on the best ``k`` of each query once, whatever the number of cells.
    """
    spark = queries.sparkSession
    ship(spark)
    want = None if k is None else k + (1 if skip_self else 0)
    cells = _Cells(items, want or 1, pivots, dim)
    if cells.empty:
        kinds = [df.schema["id"].dataType.simpleString() for df in (queries, items)]
        return spark.createDataFrame([], f"query_id {kinds[0]}, item_id {kinds[1]}, similarity double")

    plan = cells.plan()
    queries = queries.filter("id IS NOT NULL")
    if tally is not None:
        sizes = dict(zip(plan.stats["cell"], plan.stats["n"], strict=True))
        asked = _visits(queries, cells, want, floor, probes).groupBy("cell").count().collect()  # one row per pivot
        tally["compared"] = tally.get("compared", 0) + sum(int(sizes[r["cell"]]) * r["count"] for r in asked)
    deal = _deal(queries, dim, want, QUERY_BLOCK_BYTES)
    known = cells.items.select("cell", F.col("id").alias("item_id"), "vector")

    def block(rows: pd.DataFrame) -> _Block:
        return _Block(rows, want, skip_self, lambda part: _unit_rows(part, dim), plan, floor, probes)

    return _streamed(queries, known, deal, dim, block)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which of them are null; nulls hold any value of the type."""
    blank = column.is_null().to_numpy(zero_copy_only=False)
    if column.null_count:
        filler = "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else 0
        column = column.fill_null(filler)
    return column.to_numpy(zero_copy_only=False), blank


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "item_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def vector_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    id: str = "id",
    vector: str = "embedding",
    pivots: int = 64,
    probes: int | None = None,
    skip_self: bool = False,
) -> DataFrame:
    """The ``k`` most similar items per query: ``query_id, item_id, similarity, rank``.

    Exact by default; ties go to the smaller id. With ``probes`` only that many nearest
    cells are searched. Vectors that are zero or have no ``dim`` dimensions are left out;
    ``rejected_vectors`` names them.
    """
    found = _search(
        _usable(queries, id, vector, dim), _usable(items, id, vector, dim), dim,
        k=k, probes=probes, pivots=pivots, skip_self=skip_self,
    )
    return _best(found, k)


def vector_topk_approx(queries: DataFrame, items: DataFrame, k: int, dim: int, **options) -> DataFrame:
    """About the top ``k``: a short list by codes, ranked exactly (``quantized_topk``); see
    ``recall_report`` for what that loses. With ``probes`` the nearest cells only are
    searched instead, which needs most cells in many dimensions."""
    if "probes" in options:
        return vector_topk(queries, items, k, dim, **options)
    from .quantized import quantized_topk

    return quantized_topk(queries, items, k, dim, **options)


def recall_report(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """One row: exact results, how many the approximate search found, and the share."""
    hits = approx.select("query_id", "item_id", F.lit(1).alias("_hit"))
    return exact.join(hits, ["query_id", "item_id"], "left").agg(
        F.count("*").alias("expected"),
        F.count("_hit").alias("found"),
        (F.count("_hit") / F.count("*")).alias("recall"),
    )


def score_matches(
    profiles: DataFrame,
    jobs: DataFrame,
    dim: int,
    lowest_grade: str = "D",
    k: int = TOP_JOBS,
    pivots: int = 64,
) -> DataFrame:
    """``user_id, job_id, similarity, grade``: the best ``k`` jobs of each profile.

    Pairs below the lowest grade are left out; ``F`` keeps every pair.
    """
    floor = None if lowest_grade == "F" else dict(GRADE_BOUNDS)[lowest_grade]
    found = _search(
        _usable(profiles, "id", "resume_embedding", dim),
        _usable(jobs, "id", "embedding", dim),
        dim, k=k, floor=floor, pivots=pivots,
    )
    return _best(found, k).select(
        F.col("query_id").alias("user_id"),
        F.col("item_id").alias("job_id"),
        "similarity",
        grade(F.col("similarity")).alias("grade"),
    )


def best_match(scores: DataFrame, jobs: DataFrame, k: int = 10) -> DataFrame:
    """The feed in the order of the match: the first ``k`` scored jobs of each user.

    Best similarity first, then the newest, then the smaller id. Only the sort columns of
    a job travel until the ``k`` are known.
    """
    wanted = jobs.filter("is_active AND is_usa")
    narrow = scores.select("user_id", "job_id", "similarity", "grade").join(
        wanted.select(F.col("id").alias("job_id"), "posted_at"), "job_id"
    )
    order = [F.col("similarity").desc(), F.col("posted_at").desc(), F.col("job_id")]
    ranked = narrow.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
    top = ranked.filter(F.col("rank") <= k).drop("posted_at")
    return top.join(wanted.withColumnRenamed("id", "job_id"), "job_id")


def vector_hash(vector: Column) -> Column:
    """Fingerprint of a resume vector; a new value makes old scores void."""
    return F.xxhash64(vector)


def profiles_to_rescore(profiles: DataFrame, scored: DataFrame) -> DataFrame:
    """Profiles whose vector has no scores yet; ``scored(user_id, resume_hash)``."""
    current = profiles.filter(F.col("resume_embedding").isNotNull()).withColumn(
        "resume_hash", vector_hash(F.col("resume_embedding"))
    )
    done = scored.select(F.col("user_id").alias("id"), "resume_hash")
    return current.join(done, ["id", "resume_hash"], "left_anti")
