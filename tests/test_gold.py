from datetime import date

import pytest
from pyspark.sql import functions as F

from faretide import schemas
from faretide.plans import gold
from tests.helpers import dicts, trips, zones

ROWS = [
    {"pickup": "2024-03-01 08:00:00", "pulocationid": 1, "dolocationid": 2, "fare_amount": 10.0, "total_amount": 0.1},
    {"pickup": "2024-03-01 08:59:59", "pulocationid": 1, "dolocationid": 2, "fare_amount": None, "total_amount": 0.2},
    {"pickup": "2024-03-01 10:00:00", "pulocationid": 3, "dolocationid": 9, "fare_amount": 20.0, "total_amount": 0.3},
    {"pickup": "2024-03-02 17:00:00", "pulocationid": None, "dolocationid": None, "total_amount": 5.0},
]


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in dicts(df)}


def test_hourly(spark):
    hourly = rows(gold.hourly_metrics(trips(spark, *ROWS), zones(spark)), "metric_date", "metric_hour")
    first = hourly[(date(2024, 3, 1), 8)]
    assert (first["trip_count"], first["total_revenue"], first["avg_fare"]) == (2, 0.3, 10.0)
    assert (first["borough"], first["peak_hour"]) == ("Queens", True)
    assert hourly[(date(2024, 3, 1), 10)]["peak_hour"] is False
    assert hourly[(date(2024, 3, 2), 17)]["borough"] is None
    assert gold.report_columns(gold.hourly_metrics(trips(spark, *ROWS), zones(spark))).columns == (
        schemas.GOLD_HOURLY.schema.names[:14]
    )


def test_zone_performance(spark):
    by_zone = dicts(gold.zone_performance(trips(spark, *ROWS), zones(spark)))
    known = {r["zone_id"]: r for r in by_zone if r["zone_id"] is not None}
    assert (known[1]["pickup_count"], known[1]["dropoff_count"], known[1]["avg_fare"]) == (2, None, 10.0)
    # A zone where trips only end has no pickup figures at all, known by name or not.
    assert (known[2]["total_trips"], known[2]["dropoff_count"], known[2]["borough"]) == (None, 2, "Bronx")
    assert (known[9]["total_trips"], known[9]["dropoff_count"], known[9]["borough"]) == (None, 1, None)
    # Missing ids match nothing, each other included.
    unknown = [(r["pickup_count"], r["dropoff_count"]) for r in by_zone if r["zone_id"] is None]
    assert sorted(unknown, key=str) == [(1, None), (None, 1)]


def test_borough_summary(spark):
    summary = rows(gold.borough_summary(trips(spark, *ROWS), zones(spark)), "borough", "metric_date")
    queens = summary[("Queens", date(2024, 3, 1))]
    assert (queens["total_trips"], queens["trip_count_pickup"], queens["trip_count_dropoff"]) == (3, 3, 0)
    # The mean weighs trips, not hours or zones; a missing fare does not count.
    assert queens["avg_fare"] == 15.0
    nowhere = summary[(None, date(2024, 3, 2))]
    assert (nowhere["total_trips"], nowhere["trip_count_dropoff"]) == (1, 1)
    # Rows follow pickups: the Bronx and the unknown zone 9 only saw drop-offs.
    assert set(summary) == {("Queens", date(2024, 3, 1)), (None, date(2024, 3, 2))}


@pytest.mark.parametrize("report", ["zone_performance", "borough_summary"])
def test_same_from_trips_and_from_hourly(spark, report):
    t, z, stamp = trips(spark, *ROWS), zones(spark), F.lit("2024-01-01").cast("timestamp")
    direct = getattr(gold, report)(t, z, stamp)
    daily = gold.zone_daily(gold.hourly_metrics(t, z))
    rolled = getattr(gold, f"{report}_from_daily")(daily, z, stamp)
    assert sorted(map(str, dicts(direct))) == sorted(map(str, dicts(rolled)))


def test_sums_do_not_depend_on_order(spark):
    t = trips(spark, *[{"total_amount": x} for x in (0.1, 0.2, 0.3, 1e8, -1e8)])
    for parts in (1, 5):
        [row] = dicts(gold.hourly_metrics(t.repartition(parts, "total_amount"), zones(spark)))
        assert row["total_revenue"] == 0.6


def test_non_finite_measures_count_as_missing(spark):
    t = trips(spark, {"fare_amount": float("nan")}, {"fare_amount": float("inf")}, {"fare_amount": 4.0})
    [row] = dicts(gold.hourly_metrics(t, zones(spark)))
    assert (row["trip_count"], row["avg_fare"]) == (3, 4.0)


def test_refresh_replaces_only_changed_days(spark, lake):
    z = zones(spark, (1, "N/A", "Outside"), (2, "Queens", "Astoria"))
    first = trips(
        spark,
        {"pickup": "2024-03-01 08:00:00", "pulocationid": 1},
        {"pickup": "2024-03-02 08:00:00", "pulocationid": 2},
        {"pickup": "2024-03-03 08:00:00", "pulocationid": 2},
    )
    gold.refresh(lake, first, z)
    assert lake.partition_values(schemas.GOLD_ZONE) == ["N/A", "Queens"]
    # The first day loses its only trip, the second gains one. The third is not looked at.
    second = trips(
        spark,
        {"pickup": "2024-03-02 08:00:00", "pulocationid": 2},
        {"pickup": "2024-03-02 09:00:00", "pulocationid": 2},
        {"pickup": "2024-03-03 08:00:00", "pulocationid": 2, "total_amount": 999.0},
    )
    gold.refresh(lake, second, z, [date(2024, 3, 1), date(2024, 3, 2)])
    hourly = rows(lake.read(schemas.GOLD_HOURLY), "metric_date", "metric_hour")
    assert sorted(hourly) == [(date(2024, 3, 2), 8), (date(2024, 3, 2), 9), (date(2024, 3, 3), 8)]
    assert hourly[(date(2024, 3, 3), 8)]["total_revenue"] == 12.0
    borough = rows(lake.read(schemas.GOLD_BOROUGH), "borough", "metric_date")
    assert {k: r["total_trips"] for k, r in borough.items()} == {
        ("Queens", date(2024, 3, 2)): 2,
        ("Queens", date(2024, 3, 3)): 1,
    }
    # A borough without any trip left drops out of the zone table (zone 2 is where all trips end).
    zone = rows(lake.read(schemas.GOLD_ZONE), "zone_id")
    assert {k: (r["borough"], r["pickup_count"]) for k, r in zone.items()} == {(2,): ("Queens", 3)}


def test_refresh_of_everything_drops_days_that_are_gone(spark, lake):
    gold.refresh(lake, trips(spark, *ROWS), zones(spark))
    gold.refresh(lake, trips(spark, ROWS[2]), zones(spark))
    assert lake.partition_values(schemas.GOLD_HOURLY) == ["2024-03-01"]
    assert lake.read(schemas.GOLD_HOURLY).count() == 1
    assert lake.partition_values(schemas.GOLD_BOROUGH) == ["2024-03-01"]
