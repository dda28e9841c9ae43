"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, packing, quality_rules, secret_scan, simhash
from tillroll.llm._shared import cut
from tillroll.llm.tables import PACKING_TOKENIZER, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check or a risk-controlled rule rejects go.

    Null and empty texts fail the base check; a null language is a stratum of its
    own; repeated rows are judged alike, and copies count once in the holdout;
    documents without a label are judged by the cutoffs; an empty table stays
    empty; all columns, whatever their names, come through."""
    return quality_rules.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays.

    Null ids come last; null and empty texts are one group; an id on texts of
    different groups keeps a row in each; of rows that repeat id and text one
    stays; an empty table stays empty; all columns come through."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts hold none; items with a null id count too, items without
    words don't; repeated rows are judged each; an empty benchmark or table
    leaves all as it is; all columns come through."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a placeholder; n_chars follows the text.

    Null and empty texts stay as they are, rows are neither lost nor merged, other
    columns come through; where spans overlap one placeholder stands for all."""
    return secret_scan.scan_secrets(docs, redact=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces with their places in sequences of 2048 tokens.

    Null and empty texts are a piece of one token, repeated rows are packed each,
    null ids stay null, an empty table gives no pieces; other columns end here."""
    return packing.pack_documents(docs, PACKING_TOKENIZER)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret scan", secrets), ("packing", pack)]

#: SQL has no tokenizer, XXH64 or binomial bound; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
