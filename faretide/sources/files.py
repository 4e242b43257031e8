"""Dimension files, exports and the row store."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide import schemas
from faretide.operators import params
from faretide.sources.tables import checkpoints


def read_zones_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """The zone list, a CSV with header. Types are fixed unless ``infer`` asks for an extra pass."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schemas.ZONE).csv(path)


def read_row_store(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """A table of the row store over JDBC, in parallel ranges of ``partition_column``. Needs a driver jar."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()


def write_row_store(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    """Append to a row-store table in batches. Needs a driver jar."""
    writer = df.write.format("jdbc").mode("append")
    writer.options(url=url, dbtable=table, batchsize=str(batch_size), **options).save()


def export(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a result as JSON lines or as CSV with header; times as ISO text."""
    params.one_of("format", fmt, params.FORMATS)
    writer = df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.option("ignoreNullFields", False).json(path)


def read_export(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    reader = spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)


def tiered(gold, base, gold_label: str = "gold", base_label: str = "base") -> DataFrame:
    """The result of the first of two sources that gives one, with its name in ``data_source``.

    ``gold`` and ``base`` are functions giving a DataFrame. The gold attempt is run to its end and its result, a report, is
    kept under the checkpoint folder. So whatever makes it fail leads to the base source: a missing table or column,
    a data file that is gone, a footer that cannot be read.
    """
    try:
        df = gold()
        checkpoints(df.sparkSession)
        df, label = df.checkpoint(), gold_label
    except (PySparkException, Py4JJavaError):
        df, label = base(), base_label
    return df.withColumn("data_source", F.lit(label))
