"""The corpus pipeline: stages in order, each one's Parquet output the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
All but the last return the columns of ``documents``; the last one returns where each
document lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmill.llm.decontaminate import mark_windows
from jobmill.llm.language import UNKNOWN, identify, train
from jobmill.llm.mixing import copies, draw, fit, text_words
from jobmill.llm.neardup import keep_one
from jobmill.llm.q_sharding import located
from jobmill.llm.registry import table
from jobmill.llm.sharding import shard
from jobmill.llm.spans import held_out
from jobmill.llm.store import rewritten

#: A document below this kernel score is rejected; a flat guess among few languages is above it.
MIN_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told; ``und`` and hopeless scores go."""
    model = train(docs.filter(~held_out()))
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}  # apart from the operator's columns
    inner = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    found = identify(inner, model, list(names.values()), names["text"])
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return found.filter(kept).select(*[F.col(x).alias(c) for c, x in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    marked = mark_windows(inner, table(spark, sf_dir, "benchmark"), list(names.values()), names["text"])
    clean = marked.filter(F.col("hit_words").isNull())
    return clean.select(*[F.col(x).alias(c) for c, x in names.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out or repeat documents so that every source comes to its target."""
    sized = docs.withColumns({"__size": text_words("text"), "__draw": draw("doc_id", "text")})
    sizes = rewritten(
        sized.select("source", F.col("__size").alias("size"), F.col("__draw").alias("draw")), "sizes"
    )
    mixed = copies(sized, fit(sizes), size="__size", draw="__draw")
    repeated = mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spread the mix over shards of equal bytes."""
    return located(shard(docs, ["doc_id"]))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shards", shards),
]

#: The models have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = rewritten(stage(spark, docs, sf_dir), name)
    return docs
