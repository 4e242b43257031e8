"""Decoding, checking and merging of change records; bulk loading; layer checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.views import AS_OF
from faretide import schemas
from faretide.functions import clock
from faretide.operators import decode, filters, ingest, merge, quality, recon
from faretide.plans import gold
from faretide.schemas import LIVE_TRIP_CHANGES, TRIP_CHANGES, WEATHER_CHANGES
from faretide.sources import changes as change_sources
from faretide.sources import files, tables
from faretide.sources.tables import Lake, TableSpec, work_folder

PAYLOAD = ", ".join(schemas.TRIP.names)
LINEAGE = ("_processing_time", *decode.ORDER)


# -- decode ------------------------------------------------------------------------------------


@query(
    """
SELECT op, CAST(COUNT(*) AS BIGINT) AS records, CASE op WHEN 'd' THEN 'delete' ELSE 'upsert' END AS route
FROM versions GROUP BY op
UNION ALL SELECT 't', COUNT(*), 'dropped' FROM trips WHERE event_id % 50 = 3
UNION ALL SELECT NULL, COUNT(*), 'dropped' FROM trips WHERE event_id % 50 = 3
"""
)
def cdc_op_counts(spark, d):
    return decode.operation_counts(v.trip_changes(spark, d))


@query(f"SELECT {PAYLOAD}, op AS _operation FROM decoded WHERE op IN ('c', 'u', 'r')")
def cdc_decode_trips(spark, d):
    return decode.decode_upserts(v.trip_changes(spark, d), TRIP_CHANGES).drop(*LINEAGE)


@query("SELECT vendorid, ratecodeid, pulocationid, dolocationid, airport_fee FROM decoded WHERE event_id % 2 = 1"
       " AND op <> 'd'")
def cdc_case_variants(spark, d):
    """Records that use the other spelling of the columns that have two."""
    other = v.trip_changes(spark, d).filter(F.col("value").contains("PULocationID"))
    return decode.decode_upserts(other, TRIP_CHANGES).select(
        "vendorid", "ratecodeid", "pulocationid", "dolocationid", "airport_fee"
    )


@query(
    """
SELECT vendorid, tpep_pickup_datetime, tpep_dropoff_datetime FROM decoded WHERE op = 'd'
UNION ALL
-- updates that moved a row to another key: the row under its old key
SELECT vendorid, tpep_pickup_datetime, tpep_dropoff_datetime - INTERVAL 60 SECOND FROM decoded
WHERE op = 'u' AND event_id % 10 = 2 AND vendorid IS NOT NULL
"""
)
def cdc_deletes(spark, d):
    return decode.decode_deletes(v.trip_changes(spark, d), TRIP_CHANGES).select(*TRIP_CHANGES.key)


@query(
    """
SELECT time, CAST(temperature AS FLOAT) AS temperature, CAST(precipitation AS FLOAT) AS precipitation,
  CAST(humidity AS FLOAT) AS humidity, CAST(windspeed AS FLOAT) AS windspeed, 'c' AS _operation FROM bad_weather
UNION ALL
SELECT time, CAST(temperature + 1 AS FLOAT), CAST(precipitation AS FLOAT), CAST(humidity AS FLOAT),
  CAST(windspeed AS FLOAT), 'u' FROM bad_weather WHERE n % 4 = 1
"""
)
def cdc_decode_weather(spark, d):
    return decode.decode_upserts(v.weather_changes(spark, d), WEATHER_CHANGES).drop(*LINEAGE)


@query(
    f"""
SELECT * REPLACE (COALESCE(vendorid, 0) AS vendorid, COALESCE(cbd_congestion_fee, 0) AS cbd_congestion_fee)
FROM (SELECT {PAYLOAD} FROM decoded WHERE op <> 'd')
"""
)
def cdc_decode_defaults(spark, d):
    return decode.decode_upserts(v.trip_changes(spark, d), LIVE_TRIP_CHANGES).select(*schemas.TRIP.names)


@query(
    f"""
SELECT {', '.join(f'CAST({n} AS FLOAT) AS {n}' if n in v.FLOATS else n for n in schemas.TRIP.names)} FROM trips
"""
)
def cdc_snapshot_rows(spark, d):
    """A snapshot (operation r) written as files and read back as a batch."""
    path = work_folder(spark, "snapshot")
    v.trip_snapshot(spark, d).write.text(path)
    raw = change_sources.read_cdc_batch(spark, "text", path)
    return decode.decode_upserts(raw, TRIP_CHANGES).select(*schemas.TRIP.names)


@query(
    """
SELECT * FROM (VALUES ('time', 'bigint'), ('temperature', 'float'), ('precipitation', 'float'), ('humidity', 'float'),
  ('windspeed', 'float')) AS t("column", "type")
"""
)
def cdc_inferred_schema(spark, d):
    """Columns of the envelope as guessed from a record."""
    inferred = decode.infer_payload_schema(v.weather_changes(spark, d))
    rows = [(f.name, f.dataType.simpleString()) for f in inferred["after"].dataType.fields]
    return spark.createDataFrame(rows, "column string, type string")


# -- quality -----------------------------------------------------------------------------------

TRIP_STATUS = """
  CASE WHEN vendorid IS NULL THEN 'REJECTED' ELSE 'VALID' END AS _quality_status,
  CASE WHEN tpep_pickup_datetime IS NULL THEN 'REJECTED' ELSE 'VALID' END AS _pickup_status,
  CASE WHEN tpep_dropoff_datetime IS NULL THEN 'REJECTED' ELSE 'VALID' END AS _dropoff_status,
  CASE WHEN fare_amount < 0 THEN 'REJECTED' ELSE 'VALID' END AS _fare_status,
  CASE WHEN trip_distance < 0 THEN 'REJECTED' ELSE 'VALID' END AS _distance_status
"""
GOOD = "vendorid IS NOT NULL AND NOT COALESCE(fare_amount < 0, FALSE)"


def upserts(spark, d):
    return decode.decode_upserts(v.trip_changes(spark, d), TRIP_CHANGES).drop(*LINEAGE)


@query(f"SELECT {PAYLOAD}, op AS _operation, {TRIP_STATUS} FROM decoded WHERE op <> 'd'")
def quality_tag_trips(spark, d):
    return quality.tag(upserts(spark, d), quality.RULES["trips"])


@query(f"SELECT {PAYLOAD}, op AS _operation FROM decoded WHERE op <> 'd' AND {GOOD}")
def quality_accept_trips(spark, d):
    return quality.accept(upserts(spark, d), quality.RULES["trips"])


@query(
    """
SELECT 'vendor missing' AS rule, COUNT(*) AS rejected FROM decoded WHERE op <> 'd' AND vendorid IS NULL
UNION ALL SELECT 'fare negative', COUNT(*) FROM decoded WHERE op <> 'd' AND fare_amount < 0
"""
)
def quality_reject_counts(spark, d):
    return quality.reject_counts(upserts(spark, d), quality.RULES["trips"])


@query(
    """
SELECT time, CAST(temperature AS FLOAT) AS temperature, CAST(humidity AS FLOAT) AS humidity FROM (
  SELECT time, temperature, humidity FROM bad_weather
  UNION ALL SELECT time, temperature + 1, humidity FROM bad_weather WHERE n % 4 = 1)
WHERE temperature BETWEEN -100 AND 100
"""
)
def quality_weather(spark, d):
    rows = decode.decode_upserts(v.weather_changes(spark, d), WEATHER_CHANGES)
    return quality.accept(rows, quality.RULES["weather"]).select("time", "temperature", "humidity")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS x,"
       " CASE WHEN l_tax = 0 OR l_tax IS NULL THEN NULL ELSE l_quantity END AS y FROM lineitem")
def null_non_finite(spark, d):
    items = v.table(spark, d, "lineitem")
    divided = items.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide("l_extendedprice", "l_discount"))
        .alias("x"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("y"),
    )
    return quality.null_non_finite(divided)


# -- merge -------------------------------------------------------------------------------------


@query("SELECT trips.* EXCLUDE (event_id) FROM trips WHERE event_id % 10 <> 1")
def merge_delete(spark, d):
    deletes = v.trips(spark, d, "event_id").filter("event_id % 10 = 1").select(*schemas.TRIP_KEY)
    return merge.apply_deletes(v.trips(spark, d), deletes, schemas.TRIP_KEY)


@query(
    """
SELECT h AS time, CASE WHEN n % 6 = 0 THEN CAST(99 AS DOUBLE) ELSE CAST((n * 7) % 45 - 8 AS DOUBLE)
    + CASE WHEN n % 4 = 1 THEN 2 ELSE 0 END END AS temperature,
  CASE WHEN n % 6 = 0 THEN CAST(0 AS DOUBLE) WHEN n % 5 = 0 THEN CAST(n % 13 AS DOUBLE) / 2
    ELSE CAST(0 AS DOUBLE) END AS precipitation,
  CASE WHEN n % 6 = 0 THEN CAST(50 AS DOUBLE) ELSE CAST((n * 11) % 60 + 35 AS DOUBLE) END AS humidity,
  CASE WHEN n % 6 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(n % 20 AS DOUBLE) END AS windspeed
FROM all_hours
"""
)
def weather_upsert(spark, d):
    """Hours the table lacks are added; corrected hours replace what is there, the last one counts."""
    target = v.weather(spark, d)
    corrected = v.weather(spark, d, "n").filter("n % 4 = 1")
    added = v.all_hours(spark, d).filter("n % 6 = 0").selectExpr(
        "h AS time", "99.0D AS temperature", "0.0D AS precipitation", "50.0D AS humidity", "1.0D AS windspeed",
        "0L AS version",
    )
    source = added
    for version in (1, 2):
        step = corrected.withColumn("temperature", F.col("temperature") + version).drop("n")
        source = source.unionByName(step.withColumn("version", F.lit(version).cast("bigint")))
    return merge.upsert(target, source, schemas.WEATHER_KEY, ["version"])


LATEST = "ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"


@query(f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber {LATEST}) = 1")
def keep_latest_rows(spark, d):
    return merge.keep_latest(
        v.table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query(
    f"""
SELECT {PAYLOAD} FROM decoded WHERE op <> 'd'
QUALIFY row_number() OVER (PARTITION BY tpep_pickup_datetime, pulocationid, vendorid ORDER BY ts_ms DESC) = 1
"""
)
def keep_latest_trips(spark, d):
    rows = decode.decode_upserts(v.trip_changes(spark, d), TRIP_CHANGES)
    return merge.keep_latest(rows, schemas.LIVE_TRIP_KEY, decode.ORDER).select(*schemas.TRIP.names)


# -- stored tables -----------------------------------------------------------------------------


@query("SELECT * FROM bench_trips WHERE tpep_pickup_datetime >= TIMESTAMP '1998-12-01' - INTERVAL 365 DAY")
def retention_365d(spark, d):
    return tables.apply_retention(v.bench_trips(spark, d), filters.PICKUP, 365, "1998-12-01 00:00:00")


@query(
    """
SELECT strftime(tpep_pickup_datetime, '%Y%m') AS month, COUNT(*) AS trips, MIN(tpep_pickup_datetime) AS first_pickup,
  MAX(tpep_pickup_datetime) AS last_pickup FROM bench_trips GROUP BY 1
"""
)
def month_partition_counts(spark, d):
    """Stored by month and sorted, then read back."""
    lake = Lake(spark, work_folder(spark, "months"))
    rows = v.bench_trips(spark, d).withColumn("month", clock.month_key(F.col(filters.PICKUP)))
    by_month = TableSpec("trips_by_month", rows.schema, ("month",), (filters.PICKUP, "pulocationid", "vendorid"))
    lake.replace_partitions(rows, by_month)
    return lake.read(by_month).groupBy("month").agg(
        F.count("*").alias("trips"),
        F.min(filters.PICKUP).alias("first_pickup"),
        F.max(filters.PICKUP).alias("last_pickup"),
    )


@query('SELECT "LocationID", "Borough", "Zone", service_zone FROM zones')
def zones_csv(spark, d):
    """The zone list written as CSV and loaded as a new table."""
    path = work_folder(spark, "zones-csv")
    v.zones(spark, d).write.option("header", True).csv(path)
    lake = Lake(spark, work_folder(spark, "zones"))
    stored = TableSpec("taxi_zones", schemas.ZONE)
    lake.create_from(files.read_zones_csv(spark, path), stored)
    lake.create_from(files.read_zones_csv(spark, path).limit(0), stored)  # exists: left alone
    return lake.read(stored)


# -- bulk loading ------------------------------------------------------------------------------


@query(
    """
SELECT 'events.parquet' AS file_name, CAST(MIN(ts) AS DATE) AS start_date, CAST(MAX(ts) AS DATE) AS end_date,
  COUNT(*) AS total_rows FROM events
"""
)
def file_profile(spark, d):
    return ingest.file_profile(spark, f"{d}/events.parquet", "ts").drop("file_path")


@query(
    """
SELECT 'lineitem.parquet' AS file_name, CAST(MIN(l_shipdate) AS DATE) AS start_date,
  CAST(MAX(l_shipdate) AS DATE) AS end_date, COUNT(*) AS total_rows FROM lineitem
"""
)
def ledger_anti_join(spark, d):
    seen = ingest.file_profile(spark, f"{d}/events.parquet", "ts")
    new = ingest.file_profile(spark, f"{d}/lineitem.parquet", "l_shipdate")
    ledger = seen.select("file_name", F.current_timestamp().alias("ingested_at"))
    return ingest.unprocessed(seen.unionByName(new), ledger).drop("file_path")


TLC_FILE = ", ".join(
    f"CAST({n} AS FLOAT) AS {n}" if n in v.FLOATS and n != "cbd_congestion_fee" else n
    for n in schemas.TRIP.names
    if n != "cbd_congestion_fee"
)


@query(f"SELECT {TLC_FILE}, CAST(NULL AS FLOAT) AS cbd_congestion_fee FROM trips")
def normalize_columns(spark, d):
    rows = v.trips(spark, d).drop("cbd_congestion_fee").withColumnsRenamed(v.TLC_SPELLING)
    return ingest.normalize_columns(rows.withColumn("passenger_count", F.col("passenger_count").cast("double")))


@query(
    f"""
SELECT {TLC_FILE}, CAST(NULL AS FLOAT) AS cbd_congestion_fee FROM trips
UNION ALL SELECT * REPLACE (tpep_pickup_datetime + INTERVAL 31 DAY AS tpep_pickup_datetime)
FROM (SELECT {TLC_FILE}, CAST(NULL AS FLOAT) AS cbd_congestion_fee FROM trips)
"""
)
def bulk_load(spark, d):
    """Two trip files loaded in two runs; the second run takes only the file that is new."""
    folder = work_folder(spark, "trip-files")
    rows = v.trips(spark, d).drop("cbd_congestion_fee").withColumnsRenamed(v.TLC_SPELLING)
    later = rows.withColumn(filters.PICKUP, F.col(filters.PICKUP) + F.expr("INTERVAL 31 DAYS"))
    lake = Lake(spark, work_folder(spark, "bulk"))
    lake.ensure(ingest.LEDGER_TABLE)
    for month in (rows, later):
        month.write.mode("append").parquet(folder)
        ingest.load_files(spark, folder, lake)
    return lake.read(ingest.TRIP_FILES_TABLE).select(*schemas.TRIP.names)


@query(
    f"""
SELECT {TLC_FILE}, CAST(NULL AS FLOAT) AS cbd_congestion_fee FROM trips
UNION ALL SELECT {TLC_FILE}, CAST(NULL AS FLOAT) AS cbd_congestion_fee FROM trips
"""
)
def bulk_load_same_name(spark, d):
    """A folder and its copy, so that file names come twice; the second is loaded by a second run."""
    folder = work_folder(spark, "same-names")
    rows = v.trips(spark, d).drop("cbd_congestion_fee").withColumnsRenamed(v.TLC_SPELLING)
    lake = Lake(spark, work_folder(spark, "bulk"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    rows.write.parquet(f"{folder}/a")
    ingest.load_files(spark, folder, lake)
    a, b = hadoop.Path(f"{folder}/a"), hadoop.Path(f"{folder}/b")
    hadoop.FileUtil.copy(a.getFileSystem(settings), a, b.getFileSystem(settings), b, False, settings)
    ingest.load_files(spark, folder, lake)
    return lake.read(ingest.TRIP_FILES_TABLE).select(*schemas.TRIP.names)


@query(
    """
SELECT h AS time, CAST((n * 7) % 45 - 8 AS FLOAT) AS temperature,
  CAST(CASE WHEN n % 5 = 0 THEN CAST(n % 13 AS DOUBLE) / 2 ELSE 0 END AS FLOAT) AS precipitation,
  CAST((n * 11) % 60 + 35 AS FLOAT) AS humidity, CAST(n % 20 AS FLOAT) AS windspeed
FROM all_hours WHERE n % 6 <> 0
"""
)
def hourly_arrays(spark, d):
    """One archive response per day (at most 24 positions), turned into rows."""
    entry = F.struct("time", "temperature", "precipitation", "humidity", "windspeed")
    days = v.weather(spark, d).groupBy(F.to_date("time").alias("day")).agg(
        F.sort_array(F.collect_list(entry)).alias("rows")
    )
    arrays = [F.col(f"rows.{stored}").alias(name) for name, stored in ingest.HOURLY_ARRAYS.items()]
    return ingest.hourly_arrays_to_rows(days.select(F.struct(*arrays).alias("hourly")))


@query(
    f"""
, span AS (SELECT MIN(CAST(time AS DATE)) AS lo, MAX(CAST(time AS DATE)) AS hi FROM weather
    WHERE time >= DATE '2024-01-10' AND time < DATE '2024-01-21'),
files AS (SELECT 'events.parquet' AS f, CAST(MIN(ts) AS DATE) AS s, CAST(MAX(ts) AS DATE) AS e FROM events
  UNION ALL SELECT 'lineitem.parquet', CAST(MIN(l_shipdate) AS DATE), CAST(MAX(l_shipdate) AS DATE) FROM lineitem),
cut AS (SELECT f, s, LEAST(e, DATE '{AS_OF[:10]}' - INTERVAL 1 DAY)::DATE AS e FROM files)
SELECT * FROM (
  SELECT f AS parquet_file, s AS "start", LEAST(e, lo - INTERVAL 1 DAY)::DATE AS "end" FROM cut, span WHERE s < lo
  UNION ALL SELECT f, GREATEST(s, hi + INTERVAL 1 DAY)::DATE, e FROM cut, span WHERE e > hi)
WHERE "start" <= "end"
"""
)
def coverage_gaps(spark, d):
    ranges = ingest.file_profile(spark, f"{d}/events.parquet", "ts").unionByName(
        ingest.file_profile(spark, f"{d}/lineitem.parquet", "l_shipdate")
    )
    covered = v.weather(spark, d).filter(filters.date_range("time", "2024-01-10", "2024-01-20"))
    return ingest.coverage_gaps(ranges, covered, AS_OF)


# -- layer checks ------------------------------------------------------------------------------


@query(
    """
SELECT 'trips' AS table_name, COUNT(*) AS records, MIN(tpep_pickup_datetime) AS min_time,
  MAX(tpep_pickup_datetime) AS max_time FROM trips
UNION ALL SELECT 'weather', COUNT(*), MIN(time), MAX(time) FROM weather
"""
)
def table_profile(spark, d):
    return recon.profile(v.trips(spark, d), filters.PICKUP, "trips").unionByName(
        recon.profile(v.weather(spark, d), "time", "weather")
    )


LAYERS = f"""
, silver AS (SELECT * FROM decoded WHERE op <> 'd' AND {GOOD} QUALIFY row_number() OVER (
  PARTITION BY vendorid, tpep_pickup_datetime, tpep_dropoff_datetime ORDER BY ts_ms DESC) = 1),
counts AS (
  SELECT 'source' AS layer, COUNT(*) AS records FROM trips
  UNION ALL SELECT 'silver', COUNT(*) FROM silver
  UNION ALL SELECT 'gold', COUNT(*) FROM silver
  UNION ALL SELECT 'realtime', COUNT(*) FROM (SELECT DISTINCT tpep_pickup_datetime, pulocationid, vendorid
    FROM decoded WHERE op <> 'd'))
SELECT layer, records, records - (SELECT COUNT(*) FROM trips) AS difference,
  CASE WHEN records = (SELECT COUNT(*) FROM trips) THEN 'match' ELSE 'differs' END AS status FROM counts
"""


@query(LAYERS)
def layer_reconciliation(spark, d):
    rows = decode.decode_upserts(v.trip_changes(spark, d), TRIP_CHANGES)
    silver = merge.keep_latest(quality.accept(rows, quality.RULES["trips"]), schemas.TRIP_KEY, decode.ORDER)
    layers = {
        "source": v.trips(spark, d),
        "silver": silver,
        "gold": (gold.hourly_metrics(silver, v.zones(spark, d)), "trip_count"),
        "realtime": merge.keep_latest(rows, schemas.LIVE_TRIP_KEY, decode.ORDER),
    }
    return recon.compare_layers(layers, "source")


@query(
    """
SELECT (SELECT COUNT(*) FROM zones) AS zones, COUNT(*) AS trips,
  CASE WHEN (SELECT COUNT(*) FROM zones) = 25 AND COUNT(*) > 0 THEN 'working' ELSE 'needs initialization' END AS status
FROM trips
"""
)
def pipeline_verify(spark, d):
    return recon.verify(v.trips(spark, d), v.zones(spark, d), expected_zones=25)


@query("SELECT COUNT(*) AS records, COUNT(*) >= 1000 AS ready FROM trips")
def readiness(spark, d):
    return recon.readiness(v.trips(spark, d))
