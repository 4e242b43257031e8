"""Row-level changes on tables that only know whole rows.

The big side of a merge is never shuffled for its own sake: keys to remove go through an anti
join, whose small side Spark broadcasts when its size allows. Picking the latest version is a
``row_number() = 1``, which Spark turns into a per-partition limit before the shuffle, so a key
with very many versions sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_ROW = "__row"


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one that comes last in ``order`` (NULLs first). NULL keys form a group."""
    newest = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    window = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn(_ROW, F.row_number().over(window)).filter(F.col(_ROW) == 1).drop(_ROW)


def apply_deletes(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose key is among ``deletes``. NULL keys match nothing."""
    return target.join(deletes.select(*keys), list(keys), "left_anti").select(*target.columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``target`` with the rows of ``source`` added, or put in place of the row with their key."""
    latest = keep_latest(source, keys, order).select(*target.columns)
    return apply_deletes(target, latest, keys).unionByName(latest)


def latest_state(changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The live rows behind a log of upserts and deletes (``_is_delete``)."""
    return keep_latest(changes, keys, order).filter(~F.col("_is_delete"))
