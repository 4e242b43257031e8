"""The registered queries of this folder: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from faretide.llm import (
    common,
    conversation_trie,
    decontaminate,
    langid,
    licenses,
    line_dedup,
    minhash_forest,
    norm_buckets,
    quality_lines,
    sentencepiece_viterbi,
    suffix_dedup,
    superkmer_dedup,
    url_rules,
    vector_codes,
)

#: The piece file; read on the driver only.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return common.importable(spark).read.parquet(f"{folder}/{name}.parquet")


@query(quality_lines.REPORT_SQL)
def op6_quality_lines(spark: SparkSession, folder: str) -> DataFrame:
    return quality_lines.quality_report(table(spark, folder, "documents"))


@query(line_dedup.REPORT_SQL)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(table(spark, folder, "documents"))


@query(superkmer_dedup.REPORT_SQL)
def op9_superkmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return superkmer_dedup.dedup_passages(table(spark, folder, "documents"), keep_text=False)


@query()
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(table(spark, folder, "documents"), keep_text=False)


@query(minhash_forest.REPORT_SQL)
def op2_minhash_forest(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, folder, "documents"))


@query()
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "covered", "item_words", "coverage")


@query()
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("spans")


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = Path(TOKENIZER).read_bytes()
    return sentencepiece_viterbi.round_trip(table(spark, folder, "documents"), model)


@query()
def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query()
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_report(table(spark, folder, "documents")).drop("shares")


@query(norm_buckets.REPORT_SQL)
def op12_norm_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return norm_buckets.top_k(table(spark, folder, "embeddings"))


@query(vector_codes.REPORT_SQL)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


@query(conversation_trie.REPORT_SQL)
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.node_report(table(spark, folder, "conversations"))
