"""A corpus from raw documents to token ids: five stages, each over all that the stage before it kept.

Every stage is written as Parquet under the session's shared folder and read again, so a lost executor repeats one stage's
tasks at most. All stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide.llm import common, decontaminate, langid, line_dedup, minhash_forest, queries, sentencepiece_viterbi

#: Language ID rejects what has no letter, and texts whose likeliest language gets less than this of the positions' probability.
MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows."""
    network = langid.train(docs.select("doc_id", "text", "lang"))
    judged = langid.identify(docs.withColumnsRenamed(_aside(docs)), network)
    kept = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select(*(F.col(_aside(docs).get(c, c)).alias(c) for c in docs.columns))


def _aside(docs: DataFrame) -> dict[str, str]:
    """Extra columns that bear the name of a column to be added."""
    return {c: f"_own_{c}" for c in docs.columns if c.lower() in ("lang_pred", "score", "shares")}


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a text that loses all of its lines goes."""
    done = line_dedup.dedup_lines(docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}))
    kept = done.where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(common.SPACE)) != ""))
    return kept.toDF(*docs.columns, "n_lines_", "n_dropped_").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of alike texts, and all without words. Rows that share an id, or have none, are rows like others."""
    rows = docs.withColumns({"_kept_id": common.order_id(), "_kept_hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    blank = F.btrim(F.coalesce("text", F.lit("")), F.lit(common.SPACE)) == ""
    told = minhash_forest.kept_rows(docs.select("doc_id", "text")).toDF("_kept_id", "_kept_hash")
    first = rows.where(~blank).join(told, ["_kept_id", "_kept_hash"], "left_semi").dropDuplicates(["_kept_id", "_kept_hash"])
    return first.unionByName(rows.where(blank)).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_leaking(docs, benchmark).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, and whether decoding gives the text back."""
    return sentencepiece_viterbi.round_trip(docs, Path(queries.TOKENIZER).read_bytes())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("sentencepiece", token_ids),
]

#: Neither the network nor the segmentation can be said in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    common.importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir))
    return docs
