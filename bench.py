"""Seconds per query over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs to warm up and then RUNS times; the median counts. Reports are collected,
results the size of the input go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import date

from checks import registry
from checks import queries  # noqa: F401  (fills the registry)
from checks import views as v
from faretide import schemas, session
from faretide.operators import decode, merge, quality
from faretide.plans import gold, overview, series, weather, zones
from faretide.sources.tables import Lake, work_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Registered queries measured as they are.
REPORTS = [
    "dashboard_stats_bench",
    "top_zones_bench",
    "zone_performance",
    "zone_performance_borough",
    "time_series_hour_trips",
    "time_series_day_revenue",
    "time_series_week_avg_fare",
    "time_series_bench",
    "weather_condition_rollup",
    "recent_trips",
    "demand_forecast",
    "realtime_activity",
    "gold_zone_performance_bench",
    "gold_borough_summary",
    "stats_with_delta",
]
# The same with a result of the size of their input.
WHOLE_TABLES = ["keep_latest_rows", "merge_delete", "analytics_filter", "trips_with_zone", "retention_365d"]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times), 4)


def main() -> None:
    spark = session.build(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}

    def measure(name: str, action) -> None:
        results[name] = seconds(action)
        print(f"{name} {results[name]}", file=sys.stderr, flush=True)

    for name in REPORTS:  # start the JVM's compilers
        registry.QUERIES[name](spark, SF_DIR).collect()
    for name in REPORTS:
        measure(name, lambda: registry.QUERIES[name](spark, SF_DIR).collect())

    for name in WHOLE_TABLES:
        measure(name, lambda: drain(registry.QUERIES[name](spark, SF_DIR)))

    # Stored inputs: the records as a file source sends them, and the gold tables.
    records = work_folder(spark, "bench-records")
    v.trip_changes(spark, SF_DIR).repartition(int(CPUS)).write.text(records)
    raw = spark.read.text(records)
    changes = schemas.TRIP_CHANGES
    rules = quality.RULES["trips"]
    measure("cdc_decode", lambda: drain(decode.decode_upserts(raw, changes)))
    accepted = quality.accept(decode.decode_upserts(raw, changes), rules)
    measure("cdc_decode_quality_latest", lambda: drain(merge.keep_latest(accepted, schemas.TRIP_KEY, decode.ORDER)))

    lake = Lake(spark, work_folder(spark, "bench-lake"))
    trips, zone_list = v.bench_trips(spark, SF_DIR), v.zones(spark, SF_DIR)
    measure("gold_hourly_metrics_bench", lambda: drain(gold.hourly_metrics(trips, zone_list)))

    # Tables stored as the service stores them: silver by day, gold, weather, zones.
    silver_table = schemas.TableSpec(
        "silver", schemas.plus(schemas.TRIP, schemas.struct(row_date=schemas.DATE)), ("row_date",)
    )
    weather_table = schemas.TableSpec("weather", schemas.WEATHER)
    zone_table = schemas.TableSpec("zones", schemas.ZONE)
    lake.reload(v.trips(spark, SF_DIR, "to_date(ts) AS row_date"), silver_table)
    lake.reload(v.weather(spark, SF_DIR), weather_table)
    lake.reload(zone_list, zone_table)
    silver, hours, places = (lake.read(t) for t in (silver_table, weather_table, zone_table))
    measure("gold_refresh", lambda: gold.refresh(lake, silver, places))
    one_day = [date(2024, 1, 15)]
    measure("gold_refresh_one_day", lambda: gold.refresh(lake, lake.read(silver_table, one_day), places, one_day))
    hourly, borough, zone = (lake.read(t) for t in (schemas.GOLD_HOURLY, schemas.GOLD_BOROUGH, schemas.GOLD_ZONE))
    period = ("2024-01-05", "2024-01-20")
    stats = overview.dashboard_stats
    measure("dashboard_stats", lambda: stats(silver, places, hours, as_of=v.AS_OF).collect())
    measure("dashboard_stats_historical", lambda: stats(silver, places, None, *period).collect())
    measure("weather_impact", lambda: weather.weather_impact(silver, hours, *period).collect())
    measure("stats_from_gold", lambda: overview.stats_from_gold(borough, zone, *period).collect())
    measure("zones_from_gold", lambda: zones.zones_from_gold(zone).collect())
    measure("time_series_from_gold", lambda: series.time_series_from_gold(hourly, "revenue", "hour", *period).collect())

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
