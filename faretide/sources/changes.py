"""Change-stream sources. Every one gives a string column ``value`` and its position: ``partition``, ``offset``, ``timestamp``.

Offsets count within a partition only. ``timestamp`` is when the broker got the record. Files have none of these.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the topics the change records arrive on.
TOPICS = {
    "trips": "postgres.public.yellow_taxi_trips",
    "weather": "postgres.public.nyc_weather_hourly",
    "zones": "postgres.public.taxi_zones",
}
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def _named(df: DataFrame) -> DataFrame:
    kinds = {"partition": "int", "offset": "bigint", "timestamp": "timestamp"}
    position = [(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
    return df.select(F.col("value").cast("string").alias("value"), *position)


def kafka_options(topic: str, servers: str, max_records: int | None = None) -> dict[str, str]:
    """Source options; ``max_records`` bounds a micro-batch, by default it takes all that is there."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": TOPICS.get(topic, topic), **KAFKA_DEFAULTS}
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_cdc_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, options: Mapping[str, object] | None = None
) -> DataFrame:
    """Change records as a stream: ``kafka``, or files with one record per line (``text``).

    Each query on a source keeps its own checkpoint, so several can read it independently.
    """
    reader = spark.readStream.format(fmt).options(**{k: str(v) for k, v in (options or {}).items()})
    return _named(reader.load(path) if path else reader.load())


def read_cdc_batch(
    spark: SparkSession, fmt: str = "text", path: str | None = None, options: Mapping[str, object] | None = None
) -> DataFrame:
    """The same records as a batch, e.g. for a backfill or a snapshot."""
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in (options or {}).items()})
    return _named(reader.load(path) if path else reader.load())
