"""Reports over the trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.gold_queries import END, IN_RANGE, START, flat_top
from checks.registry import query
from checks.views import AS_OF, mean, money, rnd
from faretide.functions import measures
from faretide.operators import filters
from faretide.plans import activity, overview, series, trips, zones
from faretide.plans import weather as weather_plans
from faretide.sources import files
from faretide.sources.tables import Lake, work_folder

NAME = "CASE WHEN Zone IS NULL OR Zone = '' THEN 'Zone ' || pulocationid ELSE Zone END"


def stats_sql(where: str, weather: bool) -> str:
    latest = f"(SELECT {{}} FROM weather WHERE time <= TIMESTAMP '{AS_OF}' ORDER BY time DESC LIMIT 1) AS {{}}"
    columns = [latest.format(c, c) for c in ("temperature", "humidity", "precipitation")] if weather else []
    return f"""
, kept AS (SELECT * FROM trips WHERE {where}),
busiest AS (SELECT {NAME} AS zone_name, COUNT(*) AS n, pulocationid FROM kept LEFT JOIN zones
  ON pulocationid = LocationID GROUP BY ALL ORDER BY n DESC, pulocationid LIMIT 5)
SELECT COUNT(*) AS total_trips, COALESCE({money('total_amount')}, 0) AS total_revenue,
  COALESCE({mean('fare_amount')}, 0) AS avg_fare, COUNT(DISTINCT pulocationid) AS active_zones,
  (SELECT COALESCE(string_agg(zone_name || '=' || n, ';' ORDER BY n DESC, pulocationid), '') FROM busiest) AS top_zones,
  'N/A' AS peak_hour{''.join(', ' + c for c in columns)} FROM kept
"""


@query(stats_sql("TRUE", True))
def dashboard_stats(spark, d):
    return flat_top(
        overview.dashboard_stats(v.trips(spark, d), v.zones(spark, d), v.weather(spark, d), as_of=AS_OF)
    )


@query(stats_sql(IN_RANGE, False))
def dashboard_stats_historical(spark, d):
    return flat_top(overview.dashboard_stats(v.trips(spark, d), v.zones(spark, d), start=START, end=END))


@query(stats_sql(f"tpep_pickup_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR", True))
def dashboard_stats_last_hours(spark, d):
    """hours_back overrides the dates given with it."""
    return flat_top(
        overview.dashboard_stats(
            v.trips(spark, d), v.zones(spark, d), v.weather(spark, d), START, END, hours_back=72, as_of=AS_OF
        )
    )


@query(stats_sql("tpep_pickup_datetime >= TIMESTAMP '2030-01-01'", True))
def dashboard_stats_empty(spark, d):
    return flat_top(
        overview.dashboard_stats(
            v.trips(spark, d), v.zones(spark, d), v.weather(spark, d), start="2030-01-01", as_of=AS_OF
        )
    )


@query(stats_sql(IN_RANGE, False).replace("FROM trips", "FROM bench_trips").replace(
    IN_RANGE, "tpep_pickup_datetime >= DATE '1995-01-01' AND tpep_pickup_datetime < DATE '1999-01-01'"))
def dashboard_stats_bench(spark, d):
    return flat_top(
        overview.dashboard_stats(v.bench_trips(spark, d), v.zones(spark, d), start="1995-01-01", end="1998-12-31")
    )


@query(
    f"""
SELECT COUNT(*) AS total_trips, {money('total_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
  COUNT(DISTINCT pulocationid) AS active_zones FROM trips WHERE {IN_RANGE}
"""
)
def date_range_stats(spark, d):
    kept = v.trips(spark, d).filter(filters.date_range(filters.PICKUP, START, END))
    return kept.agg(
        F.count("*").alias("total_trips"),
        measures.exact_sum(F.col("total_amount")).alias("total_revenue"),
        measures.exact_mean(F.col("fare_amount")).alias("avg_fare"),
        F.countDistinct("pulocationid").alias("active_zones"),
    )


@query("SELECT COUNT(*) AS total_trips FROM trips WHERE tpep_pickup_datetime >= DATE '2024-01-21'"
       " - INTERVAL 30 DAY AND tpep_pickup_datetime < DATE '2024-01-22'")
def date_range_clamped(spark, d):
    first, last, _ = filters.clamp_range("2023-01-01", "2024-01-21", 30)
    return filters.window(v.trips(spark, d), first, last).agg(F.count("*").alias("total_trips"))


TOP = f"""
SELECT {NAME} AS zone_name, trips, revenue FROM (
  SELECT pulocationid, COUNT(*) AS trips, {money('total_amount')} AS revenue FROM {{}} GROUP BY 1
  ORDER BY trips DESC, pulocationid LIMIT {{}}) LEFT JOIN zones ON pulocationid = LocationID
"""


@query(TOP.format("trips", 5))
def top_zones(spark, d):
    return overview.top_zones(v.trips(spark, d), v.zones(spark, d))


@query(TOP.format("bench_trips", 20))
def top_zones_bench(spark, d):
    return overview.top_zones(v.bench_trips(spark, d), v.zones(spark, d), k=20)


@query("SELECT COUNT(DISTINCT pulocationid) AS active_zones FROM trips")
def active_zones(spark, d):
    return overview.active_zones(v.trips(spark, d))


@query(
    f"""
, kept AS (SELECT *, tpep_pickup_datetime >= DATE '2024-01-16' AS cur FROM trips
  WHERE tpep_pickup_datetime >= DATE '2024-01-11' AND tpep_pickup_datetime < DATE '2024-01-21'),
a AS (SELECT COUNT(*) AS total_trips, {money('total_amount')} AS total_revenue, {mean('fare_amount')} AS avg_fare,
  COUNT(DISTINCT pulocationid) AS active_zones FROM kept WHERE cur),
b AS (SELECT COUNT(*) AS prev_total_trips, {money('total_amount')} AS prev_total_revenue,
  {mean('fare_amount')} AS prev_avg_fare, COUNT(DISTINCT pulocationid) AS prev_active_zones FROM kept WHERE NOT cur)
SELECT *, total_trips - prev_total_trips AS total_trips_delta,
  total_revenue - prev_total_revenue AS total_revenue_delta, avg_fare - prev_avg_fare AS avg_fare_delta,
  active_zones - prev_active_zones AS active_zones_delta FROM a, b
"""
)
def stats_with_delta(spark, d):
    return overview.stats_with_delta(v.trips(spark, d), "2024-01-16", "2024-01-20")


ZONES = f"""
SELECT pulocationid AS zone_id, {NAME} AS zone_name,
  CASE WHEN Borough IS NULL OR Borough = '' THEN 'Unknown' ELSE Borough END AS borough, COUNT(*) AS pickups,
  {money('total_amount')} AS revenue, {mean('fare_amount')} AS avg_fare, {mean('trip_distance')} AS distance,
  COUNT(*) FILTER (WHERE dolocationid <> pulocationid) AS dropoffs
FROM trips LEFT JOIN zones ON pulocationid = LocationID WHERE {{}} GROUP BY pulocationid, Zone, Borough
"""


@query(ZONES.format("TRUE"))
def zone_performance(spark, d):
    return zones.zone_performance(v.trips(spark, d), v.zones(spark, d))


@query(ZONES.format(f"Borough IN ('ASIA', 'AFRICA') AND {IN_RANGE}") + " ORDER BY pickups DESC, zone_id LIMIT 6")
def zone_performance_borough(spark, d):
    return zones.zone_performance(
        v.trips(spark, d), v.zones(spark, d), START, END, limit=6, boroughs="ASIA,AFRICA"
    )


@query("SELECT trips.* EXCLUDE (event_id), Borough AS pu_borough FROM trips LEFT JOIN zones ON pulocationid = LocationID")
def trips_with_zone(spark, d):
    return zones.trips_with_zone(v.trips(spark, d), v.zones(spark, d))


def series_sql(source: str, interval: str, metric: str, value: str, where: str = "TRUE") -> str:
    unit = "Trips" if metric == "trip_count" else "USD"
    return f"""
SELECT strftime(date_trunc('{interval}', tpep_pickup_datetime), '%Y-%m-%dT%H:%M:%SZ') AS timestamps,
  CAST({value} AS DOUBLE) AS "values", '{metric}' AS metric_name, '{unit}' AS unit, '{interval}' AS "interval"
FROM {source} WHERE {where} GROUP BY 1
"""


@query(series_sql("trips", "hour", "trip_count", "COUNT(*)"))
def time_series_hour_trips(spark, d):
    return series.time_series(v.trips(spark, d), "trip_count", "hour")


@query(series_sql("trips", "day", "revenue", money("total_amount")))
def time_series_day_revenue(spark, d):
    return series.time_series(v.trips(spark, d), "revenue", "day")


@query(series_sql("trips", "week", "avg_fare", mean("fare_amount")))
def time_series_week_avg_fare(spark, d):
    return series.time_series(v.trips(spark, d), "avg_fare", "week")


@query(series_sql("(SELECT * REPLACE (tpep_pickup_datetime + INTERVAL 1 DAY AS tpep_pickup_datetime) FROM trips)",
                  "week", "revenue", money("total_amount")).replace(
    "strftime(date_trunc('week', tpep_pickup_datetime)",
    "strftime(date_trunc('week', tpep_pickup_datetime) - INTERVAL 1 DAY"))
def time_series_week_sunday(spark, d):
    return series.time_series(v.trips(spark, d), "revenue", "week", week_start="sunday")


@query(series_sql("trips", "hour", "trip_count", "COUNT(*)", IN_RANGE))
def time_series_capped(spark, d):
    """A range of hours, all of which are shown."""
    return series.time_series(v.trips(spark, d), "trip_count", "hour", START, END)


SUNDAY, MONDAY = "2024-01-07", "2024-01-08"


@query(series_sql("trips", "week", "trip_count", "COUNT(*)", f"tpep_pickup_datetime >= DATE '{SUNDAY}' AND tpep_pickup_datetime < DATE '{MONDAY}' + INTERVAL 1 DAY"))
def time_series_week_two_days(spark, d):
    """Two days of two weeks."""
    return series.time_series(v.trips(spark, d), "trip_count", "week", SUNDAY, MONDAY)


@query(series_sql("bench_trips", "hour", "trip_count", "COUNT(*)"))
def time_series_long(spark, d):
    """Seven years of hours."""
    return series.time_series(v.bench_trips(spark, d), "trip_count", "hour")


@query(series_sql("bench_trips", "day", "revenue", money("total_amount")))
def time_series_bench(spark, d):
    return series.time_series(v.bench_trips(spark, d), "revenue", "day")


# The weather thresholds and labels.
IMPACT = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS date, strftime(tpep_pickup_datetime, '%H:00') AS hour,
  CASE WHEN w.time IS NULL THEN 'No Weather Data' WHEN precipitation > 5 THEN 'Rainy'
    WHEN precipitation > 0 THEN 'Light Rain' WHEN temperature < 0 THEN 'Cold'
    WHEN temperature > 30 THEN 'Hot' ELSE 'Clear' END AS weather_condition,
  {rnd('AVG(temperature)', 1)} AS temperature, {rnd('AVG(humidity)', 1)} AS humidity, COUNT(*) AS trips,
  {rnd(mean('fare_amount'), 2)} AS avg_fare, {rnd(mean('trip_distance'), 2)} AS avg_distance
FROM trips LEFT JOIN weather w ON date_trunc('hour', tpep_pickup_datetime) = date_trunc('hour', w.time)
WHERE {{}} GROUP BY 1, 2, 3 ORDER BY date DESC, hour DESC
"""


@query(IMPACT.format(IN_RANGE))
def weather_impact(spark, d):
    return weather_plans.weather_impact(v.trips(spark, d), v.weather(spark, d), START, END)


@query(
    f"SELECT *, CAST(date AS TIMESTAMP) + INTERVAL (CAST(hour[1:2] AS INT)) HOUR AS time FROM ({IMPACT.format(IN_RANGE)}) ORDER BY time"
)
def weather_points(spark, d):
    """The report from the oldest hour on, as a chart draws it."""
    return weather_plans.in_time_order(weather_impact(spark, d))


@query(IMPACT.format(f"tpep_pickup_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 720 HOUR"))
def weather_impact_last_hours(spark, d):
    return weather_plans.weather_impact(v.trips(spark, d), v.weather(spark, d), as_of=AS_OF)


@query(IMPACT.format("TRUE"))
def weather_impact_all_hours(spark, d):
    return weather_plans.weather_impact(v.trips(spark, d), v.weather(spark, d), start="2000-01-01")


@query(
    f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS date, strftime(tpep_pickup_datetime, '%H:00') AS hour,
  'Unknown' AS weather_condition, CAST(20 AS DOUBLE) AS temperature, CAST(50 AS DOUBLE) AS humidity,
  COUNT(*) AS trips, {rnd(mean('fare_amount'), 2)} AS avg_fare, {rnd(mean('trip_distance'), 2)} AS avg_distance
FROM trips WHERE {IN_RANGE} GROUP BY 1, 2 ORDER BY date DESC, hour DESC
"""
)
def weather_impact_no_weather(spark, d):
    return weather_plans.weather_impact(v.trips(spark, d), None, START, END)


@query(
    f"""
SELECT weather_condition, CAST(SUM(trips) AS BIGINT) AS trips, {mean('avg_fare')} AS avg_fare,
  CAST(SUM(CAST(avg_fare AS DECIMAL(18,2)) * trips) AS DOUBLE) / SUM(trips) AS weighted_avg_fare
FROM ({IMPACT.format('TRUE')}) GROUP BY 1
"""
)
def weather_condition_rollup(spark, d):
    impact = weather_plans.weather_impact(
        v.trips(spark, d), v.weather(spark, d), start="2000-01-01", limit=None
    )
    return weather_plans.weather_condition_rollup(impact)


@query(f"SELECT time, temperature, humidity, precipitation FROM weather WHERE time <= TIMESTAMP '{AS_OF}'"
       " ORDER BY time DESC LIMIT 1")
def latest_weather(spark, d):
    return overview.latest_weather(v.weather(spark, d), AS_OF)


RECENT = """
SELECT vendorid, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id, passenger_count, trip_distance,
  fare_amount, tip_amount, total_amount FROM {} ORDER BY pickup_datetime DESC, vendorid, dropoff_datetime,
  pickup_location_id, dropoff_location_id, passenger_count, trip_distance, fare_amount, tip_amount, total_amount
"""
SINCE = "trips WHERE tpep_pickup_datetime >= TIMESTAMP '{}' - INTERVAL {} HOUR"


@query(RECENT.format(SINCE.format(AS_OF, 48)) + " LIMIT 100")
def recent_trips(spark, d):
    return trips.recent_trips(v.trips(spark, d), limit=100, hours_back=48, as_of=AS_OF)


def _exported(spark, d, fmt):
    path = work_folder(spark, f"export-{fmt}")
    source = v.trips(spark, d)
    trips.export_trips(source, path, fmt, hours_back=24, as_of=AS_OF)
    return files.read_export(spark, path, fmt, trips.recent_trips(source, as_of=AS_OF).schema)


@query(RECENT.format(SINCE.format(AS_OF, 24)))
def export_trips(spark, d):
    return _exported(spark, d, "csv")


@query(RECENT.format(SINCE.format(AS_OF, 24)))
def export_trips_json(spark, d):
    return _exported(spark, d, "json")


@query(
    """
SELECT event_id, tpep_pickup_datetime, fare_amount, (SELECT COUNT(*) FROM trips) AS total_count,
  CAST(3 AS INT) AS page, CAST(50 AS INT) AS page_size,
  CAST(ceil((SELECT COUNT(*) FROM trips) / 50.0) AS BIGINT) AS total_pages
FROM trips ORDER BY tpep_pickup_datetime, event_id LIMIT 50 OFFSET 100
"""
)
def paginate_trips(spark, d):
    rows = v.trips(spark, d, "event_id").select("event_id", filters.PICKUP, "fare_amount")
    return trips.paginate(rows, 3, 50, [filters.PICKUP, "event_id"])


@query(
    """
SELECT event_id, tpep_pickup_datetime, fare_amount, (SELECT COUNT(*) FROM trips) AS total_count,
  CAST(7 AS INT) AS page, CAST(90 AS INT) AS page_size,
  CAST(ceil((SELECT COUNT(*) FROM trips) / 90.0) AS BIGINT) AS total_pages
FROM trips ORDER BY tpep_pickup_datetime, event_id LIMIT 90 OFFSET 540
"""
)
def stored_page(spark, d):
    """A page by its number from ranges of 400 rows, so that it lies across two of them."""
    rows = v.trips(spark, d, "event_id").select("event_id", filters.PICKUP, "fare_amount")
    lake = Lake(spark, work_folder(spark, "pages"))
    return trips.Pages.store(rows, lake, "trip_pages", [filters.PICKUP, "event_id"], 400).page(7, 90)


@query(
    """
SELECT event_id, tpep_pickup_datetime, fare_amount FROM trips ORDER BY tpep_pickup_datetime, event_id LIMIT 50 OFFSET 50
"""
)
def page_after_cursor(spark, d):
    """The second page, behind the last row of the first."""
    rows, order = v.trips(spark, d, "event_id").select("event_id", filters.PICKUP, "fare_amount"), [filters.PICKUP, "event_id"]
    last = trips.page_after(rows, 50, order).collect()[-1]
    return trips.page_after(rows, 50, order, [last[c] for c in order])


@query(
    f"""
SELECT t.* EXCLUDE (event_id) FROM trips t JOIN zones ON pulocationid = LocationID
LEFT JOIN weather w ON date_trunc('hour', tpep_pickup_datetime) = w.time
WHERE {IN_RANGE} AND Borough = 'ASIA' AND pulocationid IN (2, 4, 7, 9, 12, 14, 17, 19, 22) AND fare_amount
  BETWEEN 5 AND 60 AND precipitation > 0
"""
)
def analytics_filter(spark, d):
    return filters.analytics_filter(
        v.trips(spark, d),
        v.zones(spark, d),
        v.weather(spark, d),
        START,
        END,
        zone_ids=[2, 4, 7, 9, 12, 14, 17, 19, 22],
        borough="ASIA",
        weather_conditions=["Rainy", "Light Rain"],
        min_fare=5,
        max_fare=60,
    )


@query(
    f"""
SELECT pulocationid AS location_id, {NAME} AS zone_name,
  TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR AS prediction_hour,
  CAST(ROUND(CAST(COUNT(*) * 1.1 AS DECIMAL(28,2)), 0) AS DOUBLE) AS predicted_demand, COUNT(*) AS historical_avg
FROM trips LEFT JOIN zones ON pulocationid = LocationID
WHERE tpep_pickup_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY pulocationid, Zone
ORDER BY historical_avg DESC, pulocationid LIMIT 20
"""
)
def demand_forecast(spark, d):
    forecast = activity.demand_forecast(v.trips(spark, d), v.zones(spark, d), AS_OF, k=20)
    # The two random columns have no counterpart in SQL.
    return forecast.drop("confidence_score", "weather_impact_factor")


ACTIVITY = f"""
SELECT pulocationid AS zone_id, {NAME} AS zone_name, TIMESTAMP '{AS_OF}' AS timestamp,
  COUNT(*) / CAST(10 AS DOUBLE) AS activity_score, COUNT(*) AS pickup_count,
  {money('total_amount')} AS revenue_last_hour, {rnd(mean('trip_distance') + ' / 2', 1)} AS avg_wait_time
FROM trips LEFT JOIN zones ON pulocationid = LocationID
WHERE tpep_pickup_datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR GROUP BY pulocationid, Zone
"""


FINE = "trip_distance / 3 + event_id / CAST(100000 AS DOUBLE)"


@query(
    f"""
SELECT pulocationid, CAST(ROUND(CAST(SUM(CAST(ROUND(({FINE}) * 1000000, 0) AS DECIMAL(28,0))) AS DECIMAL(28,0)) / 1000000, 6) AS DOUBLE) AS distance
FROM trips GROUP BY pulocationid
"""
)
def fine_sums(spark, d):
    """Values with five decimals and more, summed unrounded to hundredths."""
    fine = F.expr(FINE.replace("DOUBLE", "double"))
    rows = v.trips(spark, d, "event_id").groupBy("pulocationid")
    return rows.agg(measures.exact_sum(fine, measures.FINE).alias("distance"))


@query(ACTIVITY + " ORDER BY pickup_count DESC, pulocationid LIMIT 20")
def realtime_activity(spark, d):
    return activity.realtime_activity(v.trips(spark, d), v.zones(spark, d), AS_OF, k=20)


@query(
    f"""
SELECT COUNT(*) AS active_zones, CAST(SUM(pickup_count) AS BIGINT) AS total_pickups,
  {money('revenue_last_hour')} AS revenue, {mean('activity_score')} AS avg_activity FROM ({ACTIVITY})
"""
)
def activity_totals(spark, d):
    return activity.activity_totals(activity.realtime_activity(v.trips(spark, d), v.zones(spark, d), AS_OF))
