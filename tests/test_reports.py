import pytest
from pyspark.sql import functions as F

from faretide import schemas
from faretide.functions import clock
from faretide.operators import filters
from faretide.plans import activity, gold, overview, series, trips as trip_plans, weather as weather_plans, zones as zone_plans
from faretide.schemas import TableSpec
from tests.helpers import dicts, trips, weather, zones


def test_stats_of_an_empty_period(spark):
    w = weather(spark, ("2024-03-02 00:00:00", 1.0, 0.0, 50.0))
    [row] = dicts(
        overview.dashboard_stats(trips(spark, {}), zones(spark), w, start="2030-01-01", as_of="2024-03-01 00:00:00")
    )
    assert row == {
        "total_trips": 0,
        "total_revenue": 0.0,
        "avg_fare": 0.0,
        "active_zones": 0,
        "top_zones": [],
        "peak_hour": "N/A",
        "temperature": 0.0,
        "humidity": 0.0,
        "precipitation": 0.0,
    }


def test_stats_and_ranking(spark):
    t = trips(spark, *[{"pulocationid": z} for z in [7] * 3 + [3] * 2 + [1] * 2 + [2] + [None]])
    [row] = dicts(overview.dashboard_stats(t, zones(spark), k=3))
    assert (row["total_trips"], row["active_zones"]) == (9, 4)
    # Equal counts: the lower id first. No name, or an empty one: the id stands in.
    assert [(z["zone_name"], z["trips"], z["revenue"]) for z in row["top_zones"]] == [
        ("Zone 7", 3, 36.0),
        ("Astoria", 2, 24.0),
        ("Zone 3", 2, 24.0),
    ]
    assert [r["zone_name"] for r in dicts(overview.top_zones(t, zones(spark), 3))] == ["Zone 7", "Astoria", "Zone 3"]


def test_latest_weather_is_not_in_the_future(spark):
    w = weather(spark, ("2024-03-01 07:00:00", 1.0, 0.0, 50.0), ("2024-03-01 09:00:00", 2.0, 0.0, 50.0))
    [row] = dicts(overview.dashboard_stats(trips(spark, {}), zones(spark), w, as_of="2024-03-01 08:30:00"))
    assert row["temperature"] == 1.0


def test_stats_with_delta(spark):
    t = trips(
        spark,
        {"pickup": "2024-03-03 10:00:00", "fare_amount": 30.0},
        {"pickup": "2024-03-04 10:00:00", "fare_amount": 10.0, "pulocationid": 2},
        {"pickup": "2024-03-02 10:00:00", "fare_amount": 10.0},
        {"pickup": "2024-02-29 10:00:00"},
    )
    [row] = dicts(overview.stats_with_delta(t, "2024-03-03", "2024-03-04"))
    assert (row["total_trips"], row["prev_total_trips"], row["total_trips_delta"]) == (2, 1, 1)
    assert (row["avg_fare_delta"], row["active_zones_delta"]) == (10.0, 1)


def test_zone_report(spark):
    t = trips(spark, {"pulocationid": 1, "dolocationid": 1}, {"pulocationid": 1, "dolocationid": 2}, {"pulocationid": 9})
    report = dicts(zone_plans.zone_performance(t, zones(spark)))
    assert [(r["zone_id"], r["borough"], r["pickups"], r["dropoffs"]) for r in report] == [
        (1, "Queens", 2, 1),
        (9, "Unknown", 1, 1),
    ]
    assert [r["zone_id"] for r in dicts(zone_plans.zone_performance(t, zones(spark), boroughs=["Queens"]))] == [1]


def test_weeks_start_on_monday_or_sunday(spark):
    t = trips(spark, {"pickup": "2024-03-03 10:00:00"}, {"pickup": "2024-03-04 10:00:00"})  # Sunday, Monday

    def labels(**options):
        return [(r["timestamps"], r["values"]) for r in dicts(series.time_series(t, "trip_count", "week", **options))]

    assert labels() == [("2024-02-26T00:00:00Z", 1.0), ("2024-03-04T00:00:00Z", 1.0)]
    assert labels(week_start="sunday") == [("2024-03-03T00:00:00Z", 2.0)]


def test_series_keeps_its_first_points(spark):
    t = trips(spark, *[{"pickup": f"2024-03-0{d} 10:00:00"} for d in (1, 2, 3)])
    points = dicts(series.time_series(t, "revenue", "day", "2024-03-01", "2024-03-02"))
    assert [p["timestamps"] for p in points] == ["2024-03-01T00:00:00Z", "2024-03-02T00:00:00Z"]
    assert points[0]["unit"] == "USD" and points[0]["values"] == 12.0


def test_several_weather_rows_per_hour_do_not_multiply_trips(spark):
    t = trips(spark, {"pickup": "2024-03-01 08:10:00"}, {"pickup": "2024-03-01 08:40:00"})
    w = weather(spark, ("2024-03-01 08:00:00", 40.0, 0.0, 50.0), ("2024-03-01 08:30:00", -3.0, 0.0, 40.0))
    [row] = dicts(weather_plans.weather_impact(t, w, start="2024-03-01"))
    assert (row["hour"], row["trips"], row["weather_condition"], row["temperature"]) == ("08:00", 2, "Cold", -3.0)


def test_weather_conditions_in_order(spark):
    cases = {
        "Rainy": (40.0, 5.1),
        "Light Rain": (-5.0, 0.1),
        "Cold": (-0.1, 0.0),
        "Hot": (30.1, 0.0),
        "Clear": (30.0, 0.0),
    }
    t = trips(spark, *[{"pickup": f"2024-03-01 0{h}:00:00"} for h in range(6)])
    w = weather(spark, *[(f"2024-03-01 0{h}:00:00", temp, rain, 50.0) for h, (temp, rain) in enumerate(cases.values())])
    impact = weather_plans.weather_impact(t, w, start="2024-03-01")
    assert [r["weather_condition"] for r in dicts(impact)] == ["No Weather Data", *reversed(cases)]
    [unknown] = dicts(weather_plans.weather_condition_rollup(weather_plans.weather_impact(t, None, start="2024-03-01")))
    assert (unknown["weather_condition"], unknown["trips"], unknown["avg_fare"]) == ("Unknown", 6, 10.0)


def test_forecast_and_activity(spark):
    now = "2024-03-08 12:00:00"
    t = trips(spark, *[{"pickup": "2024-03-08 11:30:00"}] * 5, {"pickup": "2024-03-01 11:59:59"})
    [forecast] = dicts(activity.demand_forecast(t, zones(spark), now, seed=3))
    assert (forecast["historical_avg"], forecast["predicted_demand"]) == (5, 6.0)
    assert str(forecast["prediction_hour"]) == "2024-03-08 13:00:00"
    assert 0.7 <= forecast["confidence_score"] <= 0.95
    assert 0.9 <= forecast["weather_impact_factor"] <= 1.1
    report = activity.realtime_activity(t, zones(spark), now)
    [row] = dicts(report)
    assert (row["activity_score"], row["revenue_last_hour"], row["avg_wait_time"]) == (0.5, 60.0, 0.5)
    [totals] = dicts(activity.activity_totals(report))
    assert (totals["active_zones"], totals["total_pickups"], totals["avg_activity"]) == (1, 5, 0.5)
    [confidence] = dicts(activity.forecast_confidence(activity.demand_forecast(t, zones(spark), now)))
    assert 0.7 <= confidence["avg_confidence"] <= 0.95


def test_pages_cover_all_rows_once(spark):
    t = trips(spark, *[{"fare_amount": float(i)} for i in range(7)])
    pages = [dicts(trip_plans.paginate(t.select("fare_amount"), p, 3, ["fare_amount"])) for p in (1, 2, 3, 4)]
    assert [[r["fare_amount"] for r in page] for page in pages] == [[0, 1, 2], [3, 4, 5], [6], []]
    assert {(r["total_count"], r["total_pages"]) for page in pages for r in page} == {(7, 3)}


def test_page_by_number_reads_its_ranges_only(spark, lake):
    rows = spark.range(1000).selectExpr("CAST(id % 7 AS INT) AS a", "id AS b", "CAST(id AS STRING) AS c")
    stored = trip_plans.Pages.store(rows, lake, "paged", ["a", "b"], rows_per_range=100)
    assert sum(stored.counts) == 1000 and len(stored.counts) == 10
    want = [(r["a"], r["b"]) for r in rows.orderBy("a", "b").collect()]
    for page, size in ((1, 30), (4, 30), (33, 30), (34, 30), (35, 30), (1, 1000), (2, 450), (10, 100)):
        got = dicts(stored.page(page, size))
        assert [(r["a"], r["b"]) for r in got] == want[(page - 1) * size : page * size]
        assert all((r["total_count"], r["total_pages"]) == (1000, -(-1000 // size)) for r in got)
    last = stored.page(33, 30)
    assert len(last.inputFiles()) <= 4 and "Offset" not in last._jdf.queryExecution().toString()
    empty = trip_plans.Pages.store(rows.limit(0), lake, "none", ["a", "b"])
    assert dicts(empty.page(1, 10)) == []


def test_short_ranges_share_folders(spark, lake, monkeypatch):
    """Ranges of a few rows make no folder, and no task, each; pages that cross folders and ranges are whole."""
    rows = spark.range(1000).selectExpr("CAST(id % 7 AS INT) AS a", "id AS b")
    short = trip_plans.Pages.store(rows, lake, "short", ["a", "b"], rows_per_range=2)
    assert len(lake.partition_values(short.table)) == 1 and len(short.counts) == 500
    monkeypatch.setattr(trip_plans, "_FOLDER_ROWS", 300)
    parted = trip_plans.Pages.store(rows, lake, "parted", ["a", "b"], rows_per_range=7)
    assert len(parted.folders) == 4 and sum(parted.folders) == sum(parted.counts) == 1000 and max(parted.counts) == 7
    want = [(r["a"], r["b"]) for r in rows.orderBy("a", "b").collect()]
    for page, size in ((1, 30), (334, 3), (2, 450), (1, 1000), (143, 7)):
        for stored in (short, parted):
            assert [(r["a"], r["b"]) for r in dicts(stored.page(page, size))] == want[(page - 1) * size : page * size]


def test_pages_behind_a_cursor(spark):
    rows = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(20)], "a int, b int")
    want, got, after = [(r["a"], r["b"]) for r in rows.orderBy("a", "b").collect()], [], None
    while True:
        page = [(r["a"], r["b"]) for r in dicts(trip_plans.page_after(rows, 6, ["a", "b"], after))]
        if not page:
            break
        got, after = got + page, page[-1]
    assert got == want
    plan = trip_plans.page_after(rows, 6, ["a", "b"], (1, 7))._jdf.queryExecution().toString()
    assert "Offset" not in plan and "TakeOrderedAndProject" in plan
    with pytest.raises(ValueError):
        trip_plans.page_after(rows, 6, ["a", "b"], (1,))


@pytest.mark.parametrize("asked", [["Clear"], ["Rainy", "No Weather Data"], ["No Weather Data"], []])
def test_weather_filter_keeps_what_a_join_of_all_hours_would(spark, asked):
    t = trips(spark, *[{"pickup": f"2024-03-01 {h:02d}:{m:02d}:00"} for h in range(6) for m in (0, 59)], {"pickup": "2024-03-02 05:10:00"})
    w = weather(spark, *[(f"2024-03-01 {h:02d}:30:00", 20.0, 9.0 if h % 2 else 0.0, 50.0) for h in range(5)], ("2024-02-01 00:00:00", 1.0, 0.0, 1.0))
    kept = filters.analytics_filter(t, weather=w, weather_conditions=asked, start="2024-03-01 00:30:00", end="2024-03-01 05:59:00")
    label = lambda h: "No Weather Data" if h == 5 else "Rainy" if h % 2 else "Clear"
    want = [(h, m) for h in range(6) for m in (0, 59) if (h, m) >= (0, 30) and label(h) in asked]
    got = sorted((r["tpep_pickup_datetime"].hour, r["tpep_pickup_datetime"].minute) for r in dicts(kept))
    assert got == want


def test_weather_side_is_bounded_like_the_trips(spark, lake):
    """A report of one day reads the weather of its month, and of that the day's hours."""
    stored = TableSpec("hours", schemas.plus(schemas.WEATHER, schemas.struct(row_month=schemas.STRING)), ("row_month",))
    rows = weather(spark, *[(f"2024-{m:02d}-15 08:00:00", 20.0, 0.0, 50.0) for m in range(1, 13)])
    lake.reload(rows.withColumn("row_month", F.date_format("time", "yyyyMM")), stored)
    t = trips(spark, {"pickup": "2024-03-15 08:10:00"})
    report = weather_plans.weather_impact(t, lake.read(stored), "2024-03-15", "2024-03-15")
    assert [(r["weather_condition"], r["trips"]) for r in dicts(report)] == [("Clear", 1)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "row_month" in plan and "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan


def test_active_zones_of_days_from_gold(spark):
    t = trips(spark, {"pulocationid": 1}, {"pulocationid": 2, "pickup": "2024-03-02 01:00:00"}, {"pulocationid": 1, "pickup": "2024-03-03 01:00:00"}, {"pulocationid": None})
    daily = gold.zone_daily(t)
    for start, end in ((None, None), ("2024-03-01", "2024-03-01"), ("2024-03-02", "2024-03-03"), ("2024-04-01", None)):
        want = dicts(overview.active_zones(t, start, end))
        assert dicts(overview.active_zones_from_gold(daily, start, end)) == want
    z = zones(spark)
    [row] = dicts(overview.stats_from_gold(gold.borough_summary(t, z), gold.zone_performance(t, z), "2024-03-02", "2024-03-02", zone_daily=daily))
    assert row["active_zones"] == 1 and [x["zone_name"] for x in row["top_zones"]][:2] == ["Astoria", None]


def test_charts(spark):
    report = spark.createDataFrame([(n, n, float(n - 2) if n < 5 else None) for n in range(7)], "zone_id int, pickups int, avg_fare double")
    assert [(r["trips"], r["size"]) for r in dicts(zone_plans.charted(report))] == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 1.0), (4, 2.0)]
    times = spark.createDataFrame([("2024-03-01T08:00:00Z",), ("2024-03-01",), ("soon",), (None,)], "t string")
    got = [str(r["t"]) for r in dicts(times.select(clock.from_text(F.col("t")).alias("t")))]
    assert got == ["2024-03-01 08:00:00", "2024-03-01 00:00:00", "None", "None"]
