"""Query of language-model scores; SQL cannot express the network."""

from pyspark.sql import DataFrame, SparkSession

from .lm import Vocabulary, count_bins, score, train
from .registry import register, table


@register("op5_lm_score")
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = Vocabulary.of(count_bins(docs, "text"))
    return score(docs, vocabulary, train(docs, vocabulary), ["doc_id"])
