"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import rewritten


def _directed(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(back)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node it knows."""
    both = _directed(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    least = rewritten(least, "least")  # a node of very many links can be split
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = rewritten(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    code = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum((code / F.lit(1 << 24)).cast("long")),
            F.coalesce(F.bit_xor(code), F.lit(0)),
        ).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node, the root being the smallest node it reaches.

    Neighbour minima are aggregated before they are joined back, so a node of very many
    links is never one task's group; each round's edges are written out.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    before = None
    while True:
        edges = rewritten(_large_star(edges), "edges")
        edges = rewritten(_small_star(edges).filter("a <> b").distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
