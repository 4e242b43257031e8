from pyspark.sql import functions as F

from faretide.operators import decode, quality
from faretide.schemas import TRIP_CHANGES
from tests.helpers import dicts, raw, record, trip_payload, weather

TRIPS, WEATHER = quality.RULES["trips"], quality.RULES["weather"]


def upserts(spark, *payloads):
    return decode.decode_upserts(raw(spark, *[record("c", after=p) for p in payloads]), TRIP_CHANGES)


def test_trip_rules(spark):
    good, null_fare = trip_payload(), trip_payload(fare_amount=None, trip_distance=None)
    bad = [
        trip_payload(vendorid=None),
        trip_payload(fare_amount=-0.01),
        trip_payload(trip_distance=-1),
        trip_payload(fare_amount=-1, trip_distance=-1),
        trip_payload(tpep_pickup_datetime=None),
    ]
    rows = upserts(spark, good, null_fare, *bad)
    assert quality.accept(rows, TRIPS).count() == 2
    assert quality.accept(rows, TRIPS).columns == rows.columns
    rejected = quality.reject(rows, TRIPS)
    assert rejected.count() == len(bad)
    counts = {r["rule"]: r["rejected"] for r in dicts(quality.reject_counts(rows, TRIPS))}
    assert counts == {"vendor missing": 1, "fare negative": 2, "distance negative": 2, "pickup missing": 1}
    tagged = quality.tag(rows, TRIPS)
    assert tagged.filter("_fare_status = 'REJECTED'").count() == 2
    assert tagged.filter("_quality_status = 'VALID'").count() == len(bad) + 1


def test_nothing_is_lost_between_accept_and_reject(spark):
    rows = upserts(spark, trip_payload(), trip_payload(vendorid=None), {})
    assert quality.accept(rows, TRIPS).count() + quality.reject(rows, TRIPS).count() == rows.count()


def test_weather_range(spark):
    rows = weather(spark, *[("2024-01-01 00:00:00", t, 0.0, 50.0) for t in (-101.0, -100.0, 100.0, 101.0, None)])
    kept = quality.accept(rows, WEATHER)
    assert sorted(r["temperature"] for r in dicts(kept)) == [-100.0, 100.0]


def test_non_finite_values_become_null(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1, 1.5, [nan, 2.0]), (2, inf, None), (3, -inf, [inf]), (4, nan, [])], "id int, x double, ys array<double>"
    ).withColumn("s", F.struct("x", "id"))
    rows = dicts(quality.null_non_finite(df).orderBy("id"))
    assert [r["x"] for r in rows] == [1.5, None, None, None]
    assert [r["s"]["x"] for r in rows] == [1.5, None, None, None]
    assert [r["ys"] for r in rows] == [[None, 2.0], None, [None], []]
