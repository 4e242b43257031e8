from datetime import date

import pytest
from pyspark.sql import functions as F

from faretide.functions import clock, measures
from faretide.operators import filters, params
from faretide.plans import activity, overview, series, trips as trip_plans, zones as zone_plans
from tests.helpers import trips, weather, zones


def pickups(spark):
    return trips(
        spark,
        *[{"pickup": p} for p in ("2024-03-01 00:00:00", "2024-03-02 23:59:59.5", "2024-03-03 00:00:00", "2024-03-04 12:00:00")],
    )


def test_end_day_is_included_to_its_last_moment(spark):
    assert filters.window(pickups(spark), "2024-03-01", "2024-03-02").count() == 2
    assert filters.window(pickups(spark), date(2024, 3, 2), date(2024, 3, 3)).count() == 2
    assert filters.window(pickups(spark), end="2024-03-02").count() == 2
    assert filters.window(pickups(spark), start="2024-03-03").count() == 2
    assert filters.window(pickups(spark)).count() == 4


def test_bound_with_time_is_taken_as_it_is(spark):
    assert filters.window(pickups(spark), "2024-03-01", "2024-03-03 00:00:00").count() == 3
    assert filters.window(pickups(spark), "2024-03-01", "2024-03-02 23:59:59").count() == 1


def test_hours_override_dates(spark):
    kept = filters.window(pickups(spark), "2024-03-01", "2024-03-01", hours_back=36, as_of="2024-03-04 12:00:00")
    assert kept.count() == 2


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    pickups(spark).write.partitionBy("row_date").parquet(path)
    stored = spark.read.parquet(path)
    plan = overview.top_zones(stored, zones(spark), start="2024-03-02", end="2024-03-03")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-03-02T00:00)" in text
    assert "PartitionFilters: [isnotnull(row_date" in text
    assert "trip_distance" not in text.split("ReadSchema")[1]


def test_clamp():
    assert filters.clamp_range("2024-01-01", "2024-03-31", 30) == (date(2024, 3, 1), date(2024, 3, 31), True)
    assert filters.clamp_range("2024-03-30", "2024-03-31", 30) == (date(2024, 3, 30), date(2024, 3, 31), False)
    assert filters.clamp_range(None, "2024-03-31", 30) == (None, date(2024, 3, 31), False)


def test_series_shows_every_week_it_touches(spark):
    t = trips(spark, {"pickup": "2024-01-07 10:00:00"}, {"pickup": "2024-01-08 10:00:00"})
    rows = series.time_series(t, "trip_count", "week", "2024-01-07", "2024-01-08").collect()
    assert [r["values"] for r in rows] == [1.0, 1.0]


def test_small_values_are_not_rounded_away(spark):
    rows = spark.range(1000).select(F.lit(0.004).alias("x"))
    got = rows.agg(measures.exact_sum(F.col("x"), measures.FINE).alias("fine"), measures.value_count(F.col("x")).alias("n")).first()
    assert tuple(got) == (4.0, 1000)


def test_month_tables_are_pruned(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = trips(spark, {"pickup": "2024-01-07 10:00:00"}, {"pickup": "2024-03-08 10:00:00"}).drop("row_date")
    rows.withColumn("row_month", clock.month_key(F.col(filters.PICKUP))).write.partitionBy("row_month").parquet(path)
    stored = spark.read.schema(rows.schema.add("row_month", "string")).parquet(path)
    for kept in (
        filters.window(stored, "2024-03-01", "2024-03-31"),
        filters.window(stored, hours_back=24, as_of="2024-03-08 12:00:00"),
        activity.realtime_activity(stored, zones(spark), "2024-03-08 10:30:00"),
        activity.demand_forecast(stored, zones(spark), "2024-03-08 10:30:00"),
    ):
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(row_month" in text
        assert kept.count() == 1


@pytest.mark.parametrize(
    "call",
    [
        lambda t, z: series.time_series(t, "profit", "hour"),
        lambda t, z: series.time_series(t, "revenue", "month"),
        lambda t, z: trip_plans.recent_trips(t, limit=1001),
        lambda t, z: trip_plans.recent_trips(t, hours_back=0),
        lambda t, z: zone_plans.zone_performance(t, z, limit=0),
        lambda t, z: trip_plans.export_trips(t, "/tmp/unused", "xml"),
        lambda t, z: trip_plans.paginate(t, 0, 10, ["vendorid"]),
        lambda t, z: overview.stats_with_delta(t, "2024-01-02", "2024-01-01"),
    ],
)
def test_bad_parameters(spark, call):
    with pytest.raises(ValueError):
        call(pickups(spark), zones(spark))


def test_analytics_filter(spark):
    t = trips(
        spark,
        {"pulocationid": 1, "fare_amount": 5.0, "pickup": "2024-03-01 08:10:00"},
        {"pulocationid": 2, "fare_amount": 15.0, "pickup": "2024-03-01 08:20:00"},
        {"pulocationid": 3, "fare_amount": 25.0, "pickup": "2024-03-01 09:20:00"},
    )
    w = weather(spark, ("2024-03-01 08:00:00", 10.0, 6.0, 50.0))
    z = zones(spark)

    def fares(**conditions):
        return sorted(r["fare_amount"] for r in filters.analytics_filter(t, z, w, **conditions).collect())

    assert fares() == [5.0, 15.0, 25.0]
    assert fares(borough="Queens") == [5.0, 25.0]
    assert fares(weather_conditions=["Rainy"]) == [5.0, 15.0]
    assert fares(weather_conditions=["No Weather Data"]) == [25.0]
    assert fares(zone_ids=[2, 3], max_fare=20) == [15.0]
    assert fares(min_fare=15, start="2024-03-01", end="2024-03-01") == [15.0, 25.0]
    assert activity.realtime_activity(t, z, "2024-03-01 09:00:00").count() == 3
