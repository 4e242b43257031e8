from datetime import datetime

from faretide import schemas
from faretide.operators import decode
from faretide.schemas import LIVE_TRIP_CHANGES, LIVE_ZONE_CHANGES, TRIP_CHANGES, WEATHER_CHANGES
from tests.helpers import dicts, micros, raw, record, trip_payload


def test_one_record_of_each_kind(spark):
    payload = trip_payload()
    rows = raw(
        spark,
        record("c", after=payload),
        record("r", after=payload),
        record("u", before=payload, after=payload),
        record("d", before=payload),
        record("t"),
        '{"op":"c","after":{"vendorid":1',
        "no json at all",
        None,
    )
    counts = {(r["op"], r["route"]): r["records"] for r in dicts(decode.operation_counts(rows))}
    assert counts == {
        ("c", "upsert"): 1,
        ("r", "upsert"): 1,
        ("u", "upsert"): 1,
        ("d", "delete"): 1,
        ("t", "dropped"): 1,
        (None, "dropped"): 3,
    }
    assert decode.decode_upserts(rows, TRIP_CHANGES).count() == 3
    assert decode.decode_deletes(rows, TRIP_CHANGES).count() == 1


def test_values_and_types(spark):
    payload = trip_payload("2024-03-10 02:30:00.123456", vendorid="3.0", passenger_count="abc", fare_amount="7.25")
    [row] = dicts(decode.decode_upserts(raw(spark, record("c", after=payload, ts_ms=7)), TRIP_CHANGES))
    assert row["vendorid"] == 3
    assert row["passenger_count"] is None
    assert row["fare_amount"] == 7.25
    assert row["tpep_pickup_datetime"] == datetime(2024, 3, 10, 2, 30, 0, 123456)
    assert row["cbd_congestion_fee"] is None
    assert (row["_operation"], row["_ts_ms"]) == ("c", 7)


def test_times_do_not_follow_the_session_zone(spark):
    # 02:30 does not exist on this day in New York.
    rows = raw(spark, record("c", after=trip_payload("2024-03-10 02:30:00")))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        [row] = dicts(decode.decode_upserts(rows, TRIP_CHANGES))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["tpep_pickup_datetime"] == datetime(2024, 3, 10, 2, 30)


def test_time_outside_the_calendar_is_missing(spark):
    payload = trip_payload(tpep_pickup_datetime=9_000_000_000_000_000_000, tpep_dropoff_datetime="1.5")
    [row] = dicts(decode.decode_upserts(raw(spark, record("c", after=payload)), TRIP_CHANGES))
    assert row["tpep_pickup_datetime"] is None
    assert row["tpep_dropoff_datetime"] == datetime(1970, 1, 1, 0, 0, 0, 1)


def test_other_spelling(spark):
    payload = trip_payload()
    for name, spellings in schemas.TRIP_SPELLINGS.items():
        if name in payload:
            payload[spellings[0]] = payload.pop(name)
    [row] = dicts(decode.decode_upserts(raw(spark, record("c", after=payload)), TRIP_CHANGES))
    assert (row["vendorid"], row["pulocationid"], row["dolocationid"]) == (1, 10, 20)
    [gone] = dicts(decode.decode_deletes(raw(spark, record("d", before=payload)), TRIP_CHANGES))
    assert gone["vendorid"] == 1


def test_update_that_moves_the_key_deletes_the_old_one(spark):
    old, new = trip_payload(), trip_payload(dropoff="2024-03-01 09:00:00")
    changes = dicts(decode.decode_changes(raw(spark, record("u", before=old, after=new)), TRIP_CHANGES))
    assert sorted((c["_is_delete"], c["tpep_dropoff_datetime"].hour) for c in changes) == [(False, 9), (True, 8)]
    # Without the old key nothing can be told about it.
    assert decode.decode_changes(raw(spark, record("u", before={"id": 1}, after=new)), TRIP_CHANGES).count() == 1


def test_null_payload(spark):
    rows = raw(spark, record("c"), record("d"))
    assert decode.decode_upserts(rows, WEATHER_CHANGES).count() == 0
    # A trip without payload stays, for the quality rules to reject.
    assert decode.decode_upserts(rows, TRIP_CHANGES).count() == 1


def test_zero_defaults(spark):
    rows = raw(spark, record("c", after={"LocationID": 4}), record("c", after={"LocationID": 5, "Zone": "Astoria"}))
    decoded = decode.decode_upserts(rows, LIVE_ZONE_CHANGES).orderBy("LocationID")
    assert [(r["LocationID"], r["Zone"], r["Borough"]) for r in dicts(decoded)] == [(4, "", ""), (5, "Astoria", "")]
    [row] = dicts(decode.decode_upserts(raw(spark, record("c", after={"vendorid": 2})), LIVE_TRIP_CHANGES))
    assert row["fare_amount"] == 0.0 and row["tpep_pickup_datetime"] == datetime(1970, 1, 1)


def test_inferred_schema(spark):
    after = {"time": micros("2024-01-01"), "temperature": 1.5, "humidity": 7, "station": "KNYC"}
    rows = raw(spark, None, record("d", before={"time": 1}), record("c", after=after))
    inferred = decode.infer_payload_schema(rows)
    assert inferred["after"].dataType.simpleString() == (
        "struct<humidity:int,station:string,temperature:float,time:bigint>"
    )
    assert inferred["before"].dataType.simpleString() == "struct<time:bigint>"
    later = raw(spark, record("c", after={"time": 1, "x": None, "y": "a"}), record("c", after={"time": 2, "x": 3, "y": 1, "z": 2.5}))
    assert decode.infer_payload_schema(later)["after"].dataType.simpleString() == (
        "struct<time:bigint,x:int,y:string,z:float>"
    )
    fallback = decode.infer_payload_schema(raw(spark, None))
    assert fallback["after"].dataType.names == schemas.WEATHER.names
