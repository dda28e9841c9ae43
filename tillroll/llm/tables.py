"""Input tables and tokenizer files of the registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTING_MODEL = public_tokenizers.path("piece_bpe_32k.model")
CHAT_RANKS, CHAT_SPLIT = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
