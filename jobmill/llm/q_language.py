"""Query of language identification; SQL cannot express the model."""

from pyspark.sql import DataFrame, SparkSession

from .language import identify, train
from .registry import register, table
from .spans import held_out


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    found = identify(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
