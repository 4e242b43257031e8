"""Gold tables and the reports formed from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.registry import query
from checks.views import mean, money
from faretide import schemas
from faretide.operators import filters
from faretide.plans import gold, overview, series, zones
from faretide.schemas import GOLD_HOURLY, TableSpec
from faretide.sources import files, tables
from faretide.sources.tables import Lake, work_folder

HOURLY = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS metric_date, CAST(hour(tpep_pickup_datetime) AS INT) AS metric_hour,
  pulocationid, dolocationid, Borough AS borough, COUNT(*) AS trip_count,
  {money('total_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
  {mean('trip_distance')} AS avg_distance, {mean('passenger_count')} AS avg_passengers,
  {money('tip_amount')} AS tip_sum, {money('tolls_amount')} AS tolls_sum,
  (hour(tpep_pickup_datetime) BETWEEN 7 AND 9 OR hour(tpep_pickup_datetime) BETWEEN 17 AND 19) AS peak_hour
FROM {{source}} LEFT JOIN zones ON pulocationid = LocationID
GROUP BY 1, 2, 3, 4, 5, 13
"""


@query(HOURLY.format(source="trips"))
def gold_hourly_metrics(spark, d):
    return gold.report_columns(gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d))).drop("processed_time")


@query(HOURLY.format(source="bench_trips"))
def gold_hourly_metrics_bench(spark, d):
    return gold.report_columns(gold.hourly_metrics(v.bench_trips(spark, d), v.zones(spark, d))).drop("processed_time")


ZONE = f"""
SELECT zone_id, Zone AS zone_name, Borough AS borough, pickup_count AS total_trips, total_revenue, avg_fare,
  avg_distance, pickup_count, dropoff_count
FROM (SELECT pulocationid AS zone_id, COUNT(*) AS pickup_count, {money('total_amount')} AS total_revenue,
        {mean('fare_amount')} AS avg_fare, {mean('trip_distance')} AS avg_distance FROM {{source}} GROUP BY 1)
FULL OUTER JOIN (SELECT dolocationid AS zone_id, COUNT(*) AS dropoff_count FROM {{source}} GROUP BY 1) USING (zone_id)
LEFT JOIN zones ON zone_id = LocationID
"""


@query(ZONE.format(source="trips"))
def gold_zone_performance(spark, d):
    rows = gold.zone_performance(v.trips(spark, d), v.zones(spark, d))
    return gold.report_columns(rows).drop("last_updated")


@query(ZONE.format(source="bench_trips"))
def gold_zone_performance_bench(spark, d):
    rows = gold.zone_performance(v.bench_trips(spark, d), v.zones(spark, d))
    return gold.report_columns(rows).drop("last_updated")


@query(ZONE.format(source="trips"))
def gold_zone_from_hourly(spark, d):
    hourly = gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d))
    rows = gold.zone_performance_from_daily(gold.zone_daily(hourly), v.zones(spark, d))
    return gold.report_columns(rows).drop("last_updated")


BOROUGH = f"""
, pickups AS (
  SELECT Borough AS borough, CAST(tpep_pickup_datetime AS DATE) AS metric_date, COUNT(*) AS total_trips,
    {money('total_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
    {mean('trip_distance')} AS avg_distance
  FROM trips LEFT JOIN zones ON pulocationid = LocationID GROUP BY 1, 2),
dropoffs AS (
  SELECT Borough AS borough, CAST(tpep_pickup_datetime AS DATE) AS metric_date, COUNT(*) AS n
  FROM trips LEFT JOIN zones ON dolocationid = LocationID GROUP BY 1, 2)
SELECT p.*, p.total_trips AS trip_count_pickup, COALESCE(n, 0) AS trip_count_dropoff
FROM pickups p LEFT JOIN dropoffs q ON p.borough IS NOT DISTINCT FROM q.borough AND p.metric_date = q.metric_date
"""


@query(BOROUGH)
def gold_borough_summary(spark, d):
    rows = gold.borough_summary(v.trips(spark, d), v.zones(spark, d))
    return gold.report_columns(rows).drop("last_updated")


@query(BOROUGH)
def gold_borough_from_hourly(spark, d):
    hourly = gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d))
    rows = gold.borough_summary_from_daily(gold.zone_daily(hourly), v.zones(spark, d))
    return gold.report_columns(rows).drop("last_updated")


START, END = "2024-01-05", "2024-01-20"
IN_RANGE = f"tpep_pickup_datetime >= DATE '{START}' AND tpep_pickup_datetime < DATE '{END}' + INTERVAL 1 DAY"


def flat_top(df):
    """The list of busiest zones as text, comparable across engines."""
    return df.selectExpr(
        "* EXCEPT (top_zones)",
        "array_join(transform(top_zones, z -> concat(coalesce(z.zone_name, '?'), '=', z.trips)), ';') AS top_zones",
    )


@query(
    f"""
, busiest AS (
  SELECT COALESCE(Zone, '?') AS zone_name, COUNT(*) AS n, pulocationid FROM trips LEFT JOIN zones
    ON pulocationid = LocationID GROUP BY Zone, pulocationid ORDER BY n DESC, pulocationid LIMIT 5)
SELECT COUNT(*) AS total_trips, {money('total_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
  (SELECT COUNT(*) FROM (SELECT pulocationid FROM trips UNION SELECT dolocationid FROM trips)) AS active_zones,
  (SELECT string_agg(zone_name || '=' || n, ';' ORDER BY n DESC, pulocationid) FROM busiest) AS top_zones
FROM trips WHERE {IN_RANGE}
"""
)
def stats_from_gold(spark, d):
    t, z = v.trips(spark, d), v.zones(spark, d)
    return flat_top(
        overview.stats_from_gold(gold.borough_summary(t, z), gold.zone_performance(t, z), START, END)
    )


@query(
    f"""
SELECT zone_id, zone_name, borough, total_trips AS pickups, total_revenue AS revenue, avg_fare,
  avg_distance AS distance
FROM ({ZONE.format(source='trips')}) WHERE borough IN ('ASIA', 'EUROPE') ORDER BY pickups DESC, zone_id LIMIT 500
"""
)
def zones_from_gold(spark, d):
    z = v.zones(spark, d)
    return zones.zones_from_gold(gold.zone_performance(v.trips(spark, d), z), "ASIA,EUROPE", 500)


@query(
    f"""
SELECT strftime(date_trunc('day', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  {mean('fare_amount')} AS "values", 'avg_fare' AS metric_name, 'USD' AS unit, 'day' AS "interval"
FROM trips WHERE {IN_RANGE} GROUP BY 1
"""
)
def time_series_from_gold(spark, d):
    hourly = gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d))
    return series.time_series_from_gold(hourly, "avg_fare", "day", START, END)


@query(
    f"""
SELECT strftime(date_trunc('hour', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  CAST(COUNT(*) AS DOUBLE) AS "values", 'trip_count' AS metric_name, 'Trips' AS unit, 'hour' AS "interval"
FROM trips GROUP BY 1
"""
)
def time_series_from_gold_hour(spark, d):
    return series.time_series_from_gold(gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d)))


@query(
    f"""
SELECT strftime(date_trunc('hour', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  {money('total_amount')} AS "values", 'revenue' AS metric_name, 'USD' AS unit, 'hour' AS "interval",
  'base' AS data_source
FROM trips GROUP BY 1
"""
)
def tiered_source(spark, d):
    """The gold table was never written here, so the base table answers."""
    lake = Lake(spark, work_folder(spark, "absent"))

    return _tiered(spark, d, lake)


def _tiered(spark, d, lake):
    def from_gold():
        return series.time_series_from_gold(lake.read(GOLD_HOURLY, must_exist=True), "revenue", "hour")

    return files.tiered(from_gold, lambda: series.time_series(v.trips(spark, d), "revenue", "hour"))


@query(
    f"""
SELECT strftime(date_trunc('hour', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  {money('total_amount')} AS "values", 'revenue' AS metric_name, 'USD' AS unit, 'hour' AS "interval",
  'base' AS data_source
FROM trips GROUP BY 1
"""
)
def tiered_source_corrupt(spark, d):
    """The gold table is there, but a file of it cannot be read; that shows while the report runs."""
    lake = Lake(spark, work_folder(spark, "corrupt"))
    lake.replace_partitions(gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d)), GOLD_HOURLY)
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(lake.read(GOLD_HOURLY).inputFiles()[0])
    out = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file, True)
    out.write(bytearray(b"no parquet file at all"))
    out.close()
    return _tiered(spark, d, lake)


@query(f"SELECT COUNT(DISTINCT pulocationid) AS active_zones FROM trips WHERE {IN_RANGE}")
def active_zones_from_gold(spark, d):
    daily = gold.zone_daily(gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d)))
    return overview.active_zones_from_gold(daily, START, END)


@query(
    f"""
SELECT strftime(date_trunc('hour', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  {money('total_amount')} AS "values", 'revenue' AS metric_name, 'USD' AS unit, 'hour' AS "interval",
  'gold' AS data_source
FROM trips GROUP BY 1
"""
)
def tiered_source_gold(spark, d):
    """The gold table is there, so it answers."""
    lake = Lake(spark, work_folder(spark, "present"))
    lake.replace_partitions(gold.hourly_metrics(v.trips(spark, d), v.zones(spark, d)), GOLD_HOURLY)
    return _tiered(spark, d, lake)


@query(
    """
SELECT event_id AS x, CAST(tpep_pickup_datetime AS DATE) AS day, CAST(event_id % 2 AS INT) AS half
FROM trips WHERE CAST(tpep_pickup_datetime AS DATE) <> DATE '2024-01-03'
UNION ALL SELECT event_id + 1000000, DATE '2024-01-02', CAST(event_id % 2 AS INT)
FROM trips WHERE CAST(tpep_pickup_datetime AS DATE) = DATE '2024-01-03'
"""
)
def partition_overwrite_two_level(spark, d):
    """Days split in two: one day is added to by way of a rewrite, one runs empty; both are in scope."""
    lake = Lake(spark, work_folder(spark, "two-level"))
    kinds = schemas.struct(x=T.LongType(), day=T.DateType(), half=T.IntegerType())
    table = TableSpec("halves", kinds, partitions=("day", "half"))
    day = F.to_date(filters.PICKUP)
    rows = v.trips(spark, d, "event_id").select(
        F.col("event_id").alias("x"), day.alias("day"), (F.col("event_id") % 2).cast("int").alias("half")
    )
    lake.replace_partitions(rows, table)
    moved = rows.where("day = DATE'2024-01-03'").select(
        (F.col("x") + 1000000).alias("x"), F.lit("2024-01-02").cast("date").alias("day"), "half"
    )
    again = rows.where("day = DATE'2024-01-02'").unionByName(moved)
    lake.replace_partitions(again, table, ["2024-01-02", "2024-01-03"])
    return lake.read(table)


@query(
    f"""
, changed AS (SELECT * REPLACE (total_amount * 2 AS total_amount) FROM trips
  WHERE tpep_pickup_datetime >= DATE '{START}' AND tpep_pickup_datetime < DATE '{END}'
  UNION ALL SELECT * FROM trips
  WHERE tpep_pickup_datetime < DATE '{START}' OR tpep_pickup_datetime >= DATE '{END}' + INTERVAL 1 DAY)
{HOURLY.format(source='changed')}
"""
)
def partition_overwrite(spark, d):
    """Write all days; replace some, of which the last has no rows any more."""
    lake = Lake(spark, work_folder(spark, "overwrite"))
    t, z = v.trips(spark, d), v.zones(spark, d)
    lake.replace_partitions(gold.hourly_metrics(t, z), GOLD_HOURLY)
    # The day END loses all its trips, the days before it change.
    again = t.filter(filters.date_range(filters.PICKUP, START, f"{END} 00:00:00"))
    again = again.filter(f"tpep_pickup_datetime < TIMESTAMP_NTZ '{END} 00:00:00'")
    again = again.withColumn("total_amount", again.total_amount * 2)
    days = [r[0] for r in spark.sql(f"SELECT explode(sequence(DATE '{START}', DATE '{END}'))").collect()]
    lake.replace_partitions(gold.hourly_metrics(again, z), GOLD_HOURLY, days)
    return gold.report_columns(lake.read(GOLD_HOURLY)).drop("processed_time")


STORED = TableSpec("stored", schemas.struct(x=T.LongType(), day=T.DateType(), total=T.DoubleType()), partitions=("day",))


def _stored(spark, d, purpose):
    lake = Lake(spark, work_folder(spark, purpose))
    rows = v.trips(spark, d, "event_id").select(
        F.col("event_id").alias("x"), F.to_date(filters.PICKUP).alias("day"), F.col("total_amount").cast("double").alias("total")
    )
    lake.replace_partitions(rows, STORED)
    return lake, rows


@query(
    """
SELECT event_id AS x, CAST(tpep_pickup_datetime AS DATE) AS day,
  CASE WHEN event_id % 10 = 0 AND day(tpep_pickup_datetime) <= 9 THEN -1 ELSE total_amount END AS total FROM trips
UNION ALL SELECT event_id + 1000000, CAST(tpep_pickup_datetime AS DATE), 0 FROM trips
WHERE event_id % 100 = 0 AND day(tpep_pickup_datetime) <= 9
"""
)
def stored_upsert(spark, d):
    """Rows of nine days put in place of stored ones, of which some come twice, and new ones."""
    lake, rows = _stored(spark, d, "upsert")
    some = rows.where("x % 10 = 0 AND day(day) <= 9")
    twice = some.withColumn("total", F.lit(-2.0)).unionByName(some.withColumn("total", F.lit(-1.0)))
    new = some.where("x % 100 = 0").select((F.col("x") + 1000000).alias("x"), "day", F.lit(0.0).alias("total"))
    lake.merge(STORED, twice.unionByName(new), ["x"], ["total"])
    return lake.read(STORED)


@query(
    """
SELECT event_id AS x, CAST(CASE WHEN event_id % 10 = 0 AND day(tpep_pickup_datetime) <= 9
    THEN tpep_pickup_datetime + INTERVAL 12 DAY ELSE tpep_pickup_datetime END AS DATE) AS day,
  CASE WHEN event_id % 10 = 0 AND day(tpep_pickup_datetime) <= 9 THEN -1 ELSE total_amount END AS total
FROM trips WHERE event_id % 10 <> 1
"""
)
def stored_upsert_moves(spark, d):
    """Upserts of rows that lie in another partition now, and deletes that name keys alone."""
    lake, rows = _stored(spark, d, "moves")
    moved = rows.where("x % 10 = 0 AND day(day) <= 9").select("x", F.date_add("day", 12).alias("day"), F.lit(-1.0).alias("total"))
    lake.merge(STORED, moved, ["x"], ["total"], deletes=rows.where("x % 10 = 1").select("x"))
    return lake.read(STORED)


@query(
    """
SELECT event_id AS x, CAST(tpep_pickup_datetime AS DATE) AS day, total_amount AS total FROM trips
WHERE NOT (event_id % 3 = 0 AND day(tpep_pickup_datetime) <= 9) AND CAST(tpep_pickup_datetime AS DATE) <> DATE '2024-01-05'
"""
)
def stored_delete(spark, d):
    """Keys of nine days removed, one day wholly."""
    lake, rows = _stored(spark, d, "delete")
    gone = rows.where("x % 3 = 0 AND day(day) <= 9 OR day = DATE'2024-01-05'").select("x", "day")
    lake.merge(STORED, rows.limit(0), ["x"], deletes=gone)
    return lake.read(STORED)


@query(
    """
SELECT event_id AS x, CAST(tpep_pickup_datetime AS DATE) AS day, total_amount AS total FROM trips
WHERE CAST(tpep_pickup_datetime AS DATE) >= DATE '2024-01-20'
"""
)
def retention_stored(spark, d):
    """A table and its log without the days that are too old."""
    lake, rows = _stored(spark, d, "retention")
    log = TableSpec("stored_log", STORED.schema, STORED.partitions)
    lake.replace_partitions(rows, log)
    tables.expire(lake, STORED, 10, datetime(2024, 1, 30), (log,))
    return lake.read(STORED).join(lake.read(log).select("x"), "x", "left_semi").unionByName(
        lake.read(log).join(lake.read(STORED).select("x"), "x", "left_anti")
    )
