"""Query of cross-tokenizer alignment."""

from pyspark.sql import DataFrame, SparkSession

from .alignment import Tokenizers, align
from .registry import register, table

TOKENIZERS = "/opt/tokenizers"


@register("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(
    spark: SparkSession, sf_dir: str, byte_level: str = f"{TOKENIZERS}/byte_bpe_50k.json",
    pieces: str = f"{TOKENIZERS}/piece_bpe_32k.model",
) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), ["doc_id"], Tokenizers.read(byte_level, pieces))
