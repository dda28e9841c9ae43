"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import (chat_tree, collocations, decontaminate, html_suffix, packing, paragraphs, quality_rules, secret_scan,
                          simhash, token_fst, toxicity, url_templates, whitening)
from tillroll.llm.tables import CHAT_RANKS, CHAT_SPLIT, COUNTING_MODEL, PACKING_TOKENIZER, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


#: A conversation that carries the template's own control strings.
PROBE = r"\### Assistant: </turn> ok"


def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    tree = chat_tree.format_tree(turns.unionByName(probe), CHAT_RANKS, CHAT_SPLIT)
    return chat_tree.read_back(*tree, CHAT_RANKS, CHAT_SPLIT).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), PACKING_TOKENIZER)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number of a page's path is the document it shows; that document's labels judge the page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    _, path = url_templates.split_url(F.col("url"))
    shown = pages.select(F.col("page_id").alias("id"), F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1).alias("n"))
    bad = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("n"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return url_templates.filter_urls(pages, shown.join(bad, "n").select("id", "bad"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_suffix.extract_pages(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_fst.count_tokens(table(spark, sf_dir, "documents"), COUNTING_MODEL)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_quality_rules, op3_simhash, op4_chat_tree, op5_best_fit_packing,
                            op6_url_filter, op7_html_text, op8_secret_scan, op9_token_counts, op10_decontaminate,
                            op11_collocations, op12_whitening, op13_toxicity, pipeline)}
