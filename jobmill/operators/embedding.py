"""The embedding work queue: what to embed, in which batches, at what cost."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.location import us_like
from ..functions.regex import let
from ..functions.text import squash_ws
from .ranking import global_rank

# Fixed values of the queue.
BATCH_SIZE = 100
INPUT_CHARS = 500
TOKENS_PER_ROW = 300
MAX_TOKENS = 30_000_000
USD_PER_MILLION = 0.02


def embedding_input(title: Column, description: Column) -> Column:
    """Title and the start of the description, white space squashed."""
    text = F.substring(squash_ws(F.coalesce(description, F.lit(""))), 1, INPUT_CHARS)
    head = squash_ws(F.coalesce(title, F.lit("")))
    return F.trim(F.concat(head, F.lit(" "), text))


def embedding_queue(jobs: DataFrame, limit: int | None = None) -> DataFrame:
    """Postings without a vector in work order: ``id``, ``input``, ``priority``, ``rank``.

    First active new-grad, then active entry-level postings in US-like places, then the
    rest; by id inside a class.
    """
    first = F.col("is_active") & us_like(F.col("location"))
    priority = (
        F.when(first & (F.col("experience_level") == "new_grad"), 1)
        .when(first & (F.col("experience_level") == "entry_level"), 2)
        .otherwise(3)
    )
    waiting = jobs.filter(F.col("embedding").isNull()).select(
        "id",
        embedding_input(F.col("title"), F.col("description")).alias("input"),
        priority.alias("priority"),
    )
    order = [F.col("priority"), F.col("id")]
    ranked = global_rank(waiting, order)
    return ranked if limit is None else ranked.filter(F.col("rank") <= limit)


def embedding_batches(queue: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Batch number and position. Empty inputs leave a batch short, they do not shift it."""
    numbered = queue.withColumn("batch_no", F.floor((F.col("rank") - 1) / size) + 1)
    inside = Window.partitionBy("batch_no").orderBy("rank")
    return numbered.filter(F.col("input") != "").withColumn(
        "position", F.row_number().over(inside) - 1
    )


def embedding_budget(jobs: DataFrame, force: bool = False) -> DataFrame:
    """One row: waiting rows, estimated tokens and cost, and whether to go ahead."""
    tokens = F.count("*") * TOKENS_PER_ROW
    return jobs.filter(F.col("embedding").isNull()).agg(
        F.count("*").alias("waiting"),
        tokens.alias("tokens"),
        (tokens / 1_000_000 * USD_PER_MILLION).alias("usd"),
        (F.lit(force) | (tokens <= MAX_TOKENS)).alias("allowed"),
    )


def hashing_embedder(dim: int) -> Callable[[Column], Column]:
    """Deterministic stand-in for a model: hashed words, unit length, zero without words."""

    def number(code: Column, start: int, digits: int) -> Column:
        return F.conv(F.substring(code, start, digits), 16, 10).cast("int")

    # Each step is bound once: a copied expression would hash every word again for every
    # component of the sums, and once more for every component of the result.
    def mark(code: Column) -> Column:
        """The component of a word, counted from 1, with its sign."""
        return (number(code, 1, 4) % dim + 1) * (1 - 2 * (number(code, 5, 1) % 2))

    def add_up(marks: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(dim)),
            lambda i: F.aggregate(
                marks, F.lit(0), lambda acc, m: acc + F.when(m == i, 1).when(m == -i, -1).otherwise(0)
            ),
        )

    def unit(sums: Column) -> Column:
        squares = F.aggregate(sums, F.lit(0), lambda acc, v: acc + v * v)
        return let(
            F.sqrt(squares.cast("double")),
            lambda length: F.transform(
                sums, lambda v: F.when(length > 0, v / length).otherwise(0.0).cast("float")
            ),
        )

    def embed(text: Column) -> Column:
        words = F.filter(F.split(F.lower(text), r"\s+"), lambda x: x != "")
        marks = F.transform(words, lambda x: let(F.md5(x), mark))
        return let(let(marks, add_up), unit)

    return embed


def embed(batches: DataFrame, model: Callable[[Column], Column]) -> DataFrame:
    """Vectors of all inputs by a model that is a column expression."""
    return batches.select("batch_no", "position", model(F.col("input")).alias("embedding"))


def embed_in_batches(batches: DataFrame, fn: Callable[[pd.Series], np.ndarray]) -> DataFrame:
    """Vectors of all inputs; ``fn`` maps a series of texts to one vector per text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            vectors = fn(pdf["input"])
            yield pd.DataFrame(
                {
                    "batch_no": pdf["batch_no"],
                    "position": pdf["position"],
                    "embedding": [v.tolist() for v in np.asarray(vectors)],
                }
            )

    rows = batches.select("batch_no", "position", "input")
    return rows.mapInPandas(run, "batch_no bigint, position int, embedding array<float>")


def attach_embeddings(batches: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """``id, embedding`` of the batches that came back whole.

    A batch with a missing or surplus vector or a wrong size is rejected altogether.
    """
    expected = batches.groupBy("batch_no").agg(F.count("*").alias("_want"))
    returned = vectors.groupBy("batch_no").agg(
        F.count("*").alias("_got"),
        F.count_if(~F.coalesce(F.size("embedding") == dim, F.lit(False))).alias("_bad"),
    )
    good = (
        expected.join(returned, "batch_no")
        .filter("_want = _got AND _bad = 0")
        .select("batch_no")
    )
    joined = batches.join(vectors, ["batch_no", "position"])
    return joined.join(good, "batch_no", "left_semi").select("id", "embedding")
