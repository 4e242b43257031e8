"""What the operators of this folder share: row identity, word rules, work tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space between words, and the letters that are lower-cased.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Stands for a missing document id, which so comes after all others.
NO_ID = 2**63 - 1


def order_id(doc_id: str | Column = "doc_id") -> Column:
    """The id to order and join by: never null."""
    return F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(NO_ID)).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """(_id, _text_hash, doc_id, text) of every row, texts never null. Rows that agree in the first two are one document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        order_id().alias("_id"), F.xxhash64(text).alias("_text_hash"), F.col("doc_id"), text.alias("text")
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def lines(text: Column) -> Column:
    r"""The \n-split lines; one empty line for a null or empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where it is unset, a folder of this machine serves, but only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='work-')}")
    return context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """The frame, written once as a compressed table under the session's shared checkpoint folder and read back.

    It survives lost executors and cuts the lineage. The tables stay in that folder until it is emptied.
    """
    spark: SparkSession = df.sparkSession
    folder = shared_folder(spark)
    path = f"{folder.rstrip('/')}/work-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with a join key made of two integer ``keys``.

    A count by the keys and a join by them would share one shuffle, whose large partitions Spark cannot split. Joined by
    this key and the second of the two, each side gets a shuffle of its own, and a hot key is split.
    """
    return df.withColumn(name, F.col(keys[0]).bitwiseXOR(F.col(keys[1])))


def in_both(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose integer ``key`` is among ``keys``, with a shuffle of its own on either side, as in ``apart``."""
    salted = F.xxhash64(key).alias("_salted")
    return df.withColumn("_salted", salted).join(keys.select(key, salted), ["_salted", key], "left_semi").drop("_salted")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package also where it is neither installed nor on their path.

    On a cluster the package is installed or given by ``--py-files``; there the added folder does nothing.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark
