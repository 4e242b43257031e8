"""Streaming jobs, drained over files of change records, and the tables they leave."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.change_queries import GOOD, PAYLOAD
from checks.gold_queries import HOURLY, ZONE
from checks.registry import query
from faretide import schemas
from faretide.plans import gold
from faretide.sources.changes import read_cdc_stream
from faretide.sources.tables import Lake, work_folder
from faretide.streaming import jobs

FILES, FILES_PER_BATCH = 6, 2


def written(spark, records) -> str:
    """Change records as several files; versions of a row are spread over files and batches."""
    folder = work_folder(spark, "changes")
    write_files(records, folder)
    return folder


def write_files(records, folder: str) -> None:
    """Dealt by a hash of the text: dealing in turn would sort all texts first."""
    records.repartition(FILES, "value").write.text(folder)


def drain(spark, folder: str, lake: Lake, target: jobs.Target) -> None:
    raw = read_cdc_stream(spark, "text", folder, {"maxFilesPerTrigger": FILES_PER_BATCH})
    checkpoint = work_folder(spark, f"checkpoint-{target.current_name}")
    jobs.start_changes(raw, lake, target, checkpoint, availableNow=True).awaitTermination()


SILVER = f"""
SELECT {PAYLOAD} FROM (
  SELECT {PAYLOAD}, ts_ms, op <> 'd' AS live FROM decoded WHERE op = 'd' OR ({GOOD})
  UNION ALL SELECT * REPLACE (tpep_dropoff_datetime - INTERVAL 60 SECOND AS tpep_dropoff_datetime),
    FALSE AS live FROM (SELECT {PAYLOAD}, ts_ms FROM decoded WHERE op = 'u' AND event_id % 10 = 2))
WHERE vendorid IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY vendorid, tpep_pickup_datetime, tpep_dropoff_datetime ORDER BY ts_ms DESC) = 1 AND live
"""


@query(SILVER)
def stream_trips_silver(spark, d):
    lake = Lake(spark, work_folder(spark, "lake"))
    drain(spark, written(spark, v.trip_changes(spark, d)), lake, jobs.TRIPS)
    return lake.read(jobs.TRIPS.current).select(*schemas.TRIP.names)


@query(
    """
SELECT time, CAST(temperature AS FLOAT) AS temperature, CAST(precipitation AS FLOAT) AS precipitation,
  CAST(humidity AS FLOAT) AS humidity, CAST(windspeed AS FLOAT) AS windspeed
FROM (SELECT * REPLACE (CASE WHEN n % 4 = 1 AND temperature + 1 >= -100 THEN temperature + 1 ELSE temperature END AS temperature)
  FROM bad_weather) WHERE temperature >= -100 AND n % 9 <> 2
"""
)
def stream_weather_silver(spark, d):
    lake = Lake(spark, work_folder(spark, "lake"))
    drain(spark, written(spark, v.weather_changes(spark, d)), lake, jobs.WEATHER)
    return lake.read(jobs.WEATHER.current).select(*schemas.WEATHER.names)


@query(
    f"""
SELECT {PAYLOAD} FROM (SELECT * REPLACE (COALESCE(vendorid, 0) AS vendorid,
  COALESCE(cbd_congestion_fee, 0) AS cbd_congestion_fee) FROM decoded) WHERE op <> 'd'
QUALIFY row_number() OVER (PARTITION BY tpep_pickup_datetime, pulocationid, vendorid ORDER BY ts_ms DESC) = 1
"""
)
def stream_keep_latest(spark, d):
    lake = Lake(spark, work_folder(spark, "lake"))
    drain(spark, written(spark, v.trip_changes(spark, d)), lake, jobs.LIVE_TRIPS)
    return lake.read(jobs.LIVE_TRIPS.current).select(*schemas.TRIP.names)


def gold_after_instalments(spark, d, parts: int) -> Lake:
    """Silver in ``parts`` instalments, each of several micro-batches; the gold stream after each.

    Records are dealt out by trip and version, so corrections and deletes of a trip may come before it, or instalments later.
    """
    lake, folder = Lake(spark, work_folder(spark, "lake")), work_folder(spark, "changes")
    silver, following = work_folder(spark, "checkpoint-silver"), work_folder(spark, "checkpoint-gold")
    for part in range(parts):
        write_files(v.trip_changes(spark, d, parts, part), f"{folder}/part={part}")
        raw = read_cdc_stream(spark, "text", f"{folder}/part=*", {"maxFilesPerTrigger": FILES // 2})
        jobs.start_changes(raw, lake, jobs.TRIPS, silver, availableNow=True).awaitTermination()
        stream = jobs.start_gold(lake, lambda: v.zones(spark, d), following, backfill=False, availableNow=True)
        stream.awaitTermination()
    return lake


@query(f", silver AS ({SILVER}) {HOURLY.format(source='silver')}")
def stream_gold_refresh(spark, d):
    """Hourly gold after two instalments."""
    lake = gold_after_instalments(spark, d, 2)
    return gold.report_columns(lake.read(schemas.GOLD_HOURLY)).drop("processed_time")


@query(f", silver AS ({SILVER}) {ZONE.format(source='silver')}")
def stream_gold_delta(spark, d):
    """The all-time zone table, kept up by images of changed rows over three instalments."""
    lake = gold_after_instalments(spark, d, 3)
    return gold.report_columns(lake.read(schemas.GOLD_ZONE)).drop("last_updated")


CHANGES = f"""
, changes AS (
  SELECT op = 'd' AS gone, vendorid, fare_amount FROM decoded
  UNION ALL SELECT TRUE, vendorid, fare_amount FROM decoded WHERE op = 'u' AND event_id % 10 = 2 AND vendorid IS NOT NULL),
reasons AS (
  SELECT 'key missing' AS outcome, COUNT(*) AS changes FROM changes WHERE gone AND vendorid IS NULL
  UNION ALL SELECT 'vendor missing', COUNT(*) FROM changes WHERE NOT gone AND vendorid IS NULL
  UNION ALL SELECT 'fare negative', COUNT(*) FROM changes WHERE NOT gone AND fare_amount < 0
  UNION ALL SELECT 'no change record', 2 * COUNT(*) FROM trips WHERE event_id % 50 = 3)
SELECT * FROM reasons WHERE changes > 0
UNION ALL SELECT 'accepted', COUNT(*) FROM changes WHERE vendorid IS NOT NULL AND (gone OR NOT COALESCE(fare_amount < 0, FALSE))
UNION ALL SELECT 'rejected', (SELECT COUNT(*) FROM changes WHERE vendorid IS NULL OR (NOT gone AND fare_amount < 0))
  + (SELECT 2 * COUNT(*) FROM trips WHERE event_id % 50 = 3)
"""


@query(CHANGES)
def stream_rejects(spark, d):
    """What became of every change record: accepted, or rejected for one reason or several."""
    lake = Lake(spark, work_folder(spark, "lake"))
    drain(spark, written(spark, v.trip_changes(spark, d)), lake, jobs.TRIPS)
    rejects = lake.read(jobs.TRIPS.rejects)
    accepted = lake.read(jobs.TRIPS.log).select("_batch").unionByName(lake.read(jobs.TRIPS.deletes).select("_batch"))
    outcomes = [
        rejects.select(F.explode("reject_reasons").alias("outcome")),
        rejects.select(F.lit("rejected").alias("outcome")),
        accepted.select(F.lit("accepted").alias("outcome")),
    ]
    every = outcomes[0].unionByName(outcomes[1]).unionByName(outcomes[2])
    return every.groupBy("outcome").agg(F.count("*").alias("changes"))


@query(
    f"""
, silver AS ({SILVER})
SELECT {PAYLOAD} FROM silver WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-10'
"""
)
def stream_late_changes(spark, d):
    """Silver whose older days expired between two instalments; changes that come for them later are rejected."""
    lake, folder = Lake(spark, work_folder(spark, "lake")), work_folder(spark, "changes")
    checkpoint = work_folder(spark, "checkpoint-silver")
    for part in range(2):
        write_files(v.trip_changes(spark, d, 2, part), f"{folder}/part={part}")
        raw = read_cdc_stream(spark, "text", f"{folder}/part=*")
        jobs.start_changes(raw, lake, jobs.TRIPS, checkpoint, availableNow=True).awaitTermination()
        jobs.expire(lake, jobs.TRIPS, 5, datetime(2024, 1, 15))
    return lake.read(jobs.TRIPS.current).select(*schemas.TRIP.names)
