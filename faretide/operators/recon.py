"""Checks that the layers hold what they should."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXPECTED_ZONES = 265
MIN_SILVER_ROWS = 1000


def profile(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows, first and last time of a table."""
    return df.agg(
        F.count("*").alias("records"), F.min(column).alias("min_time"), F.max(column).alias("max_time")
    ).select(F.lit(name).alias("table_name"), "records", "min_time", "max_time")


def compare_layers(layers: Mapping[str, DataFrame | tuple[DataFrame, str]], source: str) -> DataFrame:
    """Rows per layer against the ``source`` layer.

    A layer given with a column name counts what that column adds up to (rows of an aggregate).
    """
    counts = []
    for name, layer in layers.items():
        if isinstance(layer, tuple):
            rows = layer[0].agg(F.coalesce(F.sum(layer[1]), F.lit(0)).cast("bigint").alias("records"))
        else:
            rows = layer.agg(F.count("*").alias("records"))
        counts.append(rows.select(F.lit(name).alias("layer"), "records"))
    # One row per layer from here on, so one task may see them all.
    every = reduce(DataFrame.unionByName, counts)
    expected = F.max(F.when(F.col("layer") == source, F.col("records"))).over(Window.partitionBy())
    return every.withColumn("difference", F.col("records") - expected).withColumn(
        "status", F.when(F.col("difference") == 0, "match").otherwise("differs")
    )


def verify(trips: DataFrame, zones: DataFrame, expected_zones: int = EXPECTED_ZONES) -> DataFrame:
    """The overall check: every zone is there, and there are trips."""
    counted = zones.agg(F.count("*").alias("zones")).withColumn(
        "trips", trips.agg(F.count("*").alias("trips")).scalar()
    )
    working = (F.col("zones") == expected_zones) & (F.col("trips") > 0)
    return counted.withColumn("status", F.when(working, "working").otherwise("needs initialization"))


def readiness(df: DataFrame, min_rows: int = MIN_SILVER_ROWS) -> DataFrame:
    """Row count and whether it reaches the minimum."""
    return df.agg(F.count("*").alias("records")).withColumn("ready", F.col("records") >= min_rows)


def is_ready(df: DataFrame, min_rows: int = MIN_SILVER_ROWS) -> bool:
    """Whether a table has ``min_rows`` rows; reads only as many partitions as that takes."""
    return min_rows <= 0 or not df.select(F.lit(1)).offset(min_rows - 1).isEmpty()
