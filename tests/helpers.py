"""Small literal inputs."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from faretide import schemas
from faretide.sources.tables import conform


def micros(text: str) -> int:
    moment = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return round(moment.timestamp() * 1_000_000)


def trip_payload(pickup="2024-03-01 08:00:00", dropoff="2024-03-01 08:30:00", **values) -> dict:
    row = {"vendorid": 1, "pulocationid": 10, "dolocationid": 20, "fare_amount": 10.5, "total_amount": 12.0}
    row |= {"trip_distance": 2.5, "passenger_count": 1, "tip_amount": 1.0, "tolls_amount": 0.5}
    times = {"tpep_pickup_datetime": micros(pickup), "tpep_dropoff_datetime": micros(dropoff)}
    return row | times | values


def record(op, before=None, after=None, **extra) -> str:
    return json.dumps({"op": op, "before": before, "after": after, **extra})


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def trips(spark, *rows: dict):
    """Silver trips; ``pickup`` and ``dropoff`` stand for the long column names."""
    full = []
    for row in rows:
        row = {"pickup": "2024-03-01 08:00:00", **row}
        row.setdefault("dropoff", row["pickup"])
        full.append(
            {
                "vendorid": 1,
                "pulocationid": 1,
                "dolocationid": 2,
                "passenger_count": 1,
                "trip_distance": 1.0,
                "fare_amount": 10.0,
                "tip_amount": 0.0,
                "tolls_amount": 0.0,
                "total_amount": 12.0,
                **row,
            }
        )
    types = {f.name: f.dataType.simpleString() for f in schemas.TRIP.fields}
    columns = [
        "vendorid", "pulocationid", "dolocationid", "passenger_count", "trip_distance", "fare_amount",
        "tip_amount", "tolls_amount", "total_amount",
    ]
    ddl = ", ".join(f"{c} {types[c]}" for c in columns) + ", pickup string, dropoff string"
    data = [tuple(r[c] for c in [*columns, "pickup", "dropoff"]) for r in full]
    df = spark.createDataFrame(data, ddl)
    return df.select(
        *columns,
        F.col("pickup").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("dropoff").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.to_date("pickup").alias("row_date"),
    )


def zones(spark, *rows):
    rows = rows or ((1, "Queens", "Astoria"), (2, "Bronx", "Fordham"), (3, "Queens", ""))
    return spark.createDataFrame([(*r, "Yellow Zone") for r in rows], schemas.ZONE)


def weather(spark, *rows):
    """(time, temperature, precipitation, humidity)"""
    df = spark.createDataFrame(
        [(*r, 1.0) for r in rows], "time string, temperature float, precipitation float, humidity float, windspeed float"
    )
    return conform(df.withColumn("time", F.col("time").cast("timestamp_ntz")), schemas.WEATHER)


def dicts(df) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
