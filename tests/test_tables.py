from datetime import datetime

import pytest

from faretide.operators import ingest, recon
from faretide.schemas import DATE, INT, STRING, WEATHER, ZONE, TableSpec, struct
from faretide.sources import changes, files, tables
from tests.helpers import dicts, trips, weather, zones

DAILY = TableSpec("daily", struct(x=INT, day=DATE), ("day",))


def daily(spark, *rows):
    return spark.createDataFrame(rows, "x int, day string").selectExpr("x", "CAST(day AS DATE) AS day")


def contents(lake):
    return sorted((r["x"], str(r["day"])) for r in lake.read(DAILY).collect())


def test_replace_partitions(spark, lake):
    assert lake.read(DAILY).count() == 0
    lake.replace_partitions(daily(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, None)), DAILY)
    lake.replace_partitions(daily(spark, (9, "2024-01-02")), DAILY)
    assert contents(lake) == [(1, "2024-01-01"), (3, "None"), (9, "2024-01-02")]
    # Of the scope, days without rows are dropped; a day outside it stays.
    lake.replace_partitions(daily(spark, (8, "2024-01-02")), DAILY, ["2024-01-02", "2024-01-01", "2024-05-05", None])
    assert contents(lake) == [(8, "2024-01-02")]
    lake.replace_partitions(daily(spark).limit(0), DAILY, ["2024-01-02"])
    assert contents(lake) == []


def test_catalog_table(spark, lake):
    lake.replace_partitions(daily(spark, (1, "2024-01-01")), DAILY)
    lake.ensure(DAILY, "faretide_test")
    lake.ensure(DAILY, "faretide_test")
    assert spark.sql("SELECT x FROM faretide_test.daily WHERE day = DATE '2024-01-01'").collect()[0][0] == 1
    spark.sql("DROP DATABASE faretide_test CASCADE")
    assert contents(lake) == [(1, "2024-01-01")]


def test_create_reload_append(spark, lake):
    table = TableSpec("taxi_zones", ZONE)
    assert lake.create_from(zones(spark), table) is True
    assert lake.create_from(zones(spark, (9, "x", "y")), table) is False
    assert lake.read(table).count() == 3
    lake.append(zones(spark, (9, "x", "y")), table)
    assert lake.read(table).count() == 4
    lake.reload(zones(spark, (9, "x", "y")), table)
    assert [r["LocationID"] for r in lake.read(table).collect()] == [9]


def test_retention(spark, lake):
    rows = daily(spark, (1, "2023-01-01"), (2, "2024-01-01"), (3, "2024-12-31"))
    lake.replace_partitions(rows, DAILY)
    assert tables.expire(lake, DAILY, 365, datetime(2024, 12, 31)) == ["2023-01-01"]
    assert [x for x, _ in contents(lake)] == [2, 3]
    monthly = TableSpec("monthly", struct(x=INT, month=STRING), ("month",))
    rows = spark.createDataFrame([(1, "202312"), (2, "202401"), (3, "202402"), (4, None)], monthly.schema)
    lake.replace_partitions(rows, monthly)
    assert tables.expire(lake, monthly, 365, datetime(2025, 1, 31)) == ["202312", "202401"]
    assert sorted(r["x"] for r in lake.read(monthly).collect()) == [3, 4]
    t = trips(spark, {"pickup": "2024-01-01 11:59:59"}, {"pickup": "2024-01-01 12:00:00"})
    assert tables.apply_retention(t, "tpep_pickup_datetime", 365, "2024-12-31 12:00:00").count() == 1


def test_first_readable_source(spark, lake):
    missing = lambda: spark.read.parquet(lake.root + "/missing")
    assert tables.read_first([missing, lambda: zones(spark)]).count() == 3
    assert dicts(files.tiered(missing, lambda: spark.range(1)))[0]["data_source"] == "base"
    assert dicts(files.tiered(lambda: spark.range(1), missing))[0]["data_source"] == "gold"


def test_zone_file(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n2,"Queens",,\n')
    for infer in (False, True):
        rows = dicts(files.read_zones_csv(spark, str(path), infer))
        assert [(r["LocationID"], r["Zone"]) for r in rows] == [(1, "Newark Airport"), (2, None)]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_export_and_read_back(spark, tmp_path, fmt):
    df = trips(spark, {"fare_amount": None}).drop("row_date")
    files.export(df, str(tmp_path / fmt), fmt)
    assert files.read_export(spark, str(tmp_path / fmt), fmt, df.schema).collect() == df.collect()


def test_kafka_options():
    options = changes.kafka_options("trips", "broker:9092", 10_000)
    assert options["subscribe"] == "postgres.public.yellow_taxi_trips"
    assert (options["startingOffsets"], options["maxOffsetsPerTrigger"]) == ("earliest", "10000")
    assert "maxOffsetsPerTrigger" not in changes.kafka_options("weather", "broker:9092")


def gaps(spark, ranges, covered, as_of="2024-06-01 00:00:00"):
    df = spark.createDataFrame(ranges, "file_name string, s string, e string").selectExpr(
        "file_name", "CAST(s AS DATE) AS start_date", "CAST(e AS DATE) AS end_date"
    )
    w = weather(spark, *[(f"{d} 00:00:00", 1.0, 0.0, 50.0) for d in covered])
    return [
        (r["parquet_file"], str(r["start"]), str(r["end"]))
        for r in ingest.coverage_gaps(df, w, as_of).orderBy("parquet_file", "start").collect()
    ]


def test_coverage_gaps(spark):
    covered = ["2024-02-10", "2024-02-20"]
    ranges = [
        ("both", "2024-02-01", "2024-02-28"),
        ("front", "2024-02-01", "2024-02-15"),
        ("inside", "2024-02-11", "2024-02-19"),
        ("outside", "2024-03-01", "2024-03-02"),
        ("running", "2024-02-15", "2024-12-31"),
    ]
    assert gaps(spark, ranges, covered) == [
        ("both", "2024-02-01", "2024-02-09"),
        ("both", "2024-02-21", "2024-02-28"),
        ("front", "2024-02-01", "2024-02-09"),
        ("outside", "2024-03-01", "2024-03-02"),
        ("running", "2024-02-21", "2024-05-31"),
    ]
    assert gaps(spark, ranges[:1], []) == [("both", "2024-02-01", "2024-02-28")]
    assert gaps(spark, [("future", "2024-07-01", "2024-07-02")], covered) == []


def test_bulk_load_skips_what_it_has(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    trips(spark, {}, {}).drop("row_date").withColumnRenamed("vendorid", "VendorID").coalesce(1).write.parquet(folder)
    first = ingest.load_files(spark, folder, lake)
    assert len(first) == 1
    assert ingest.load_files(spark, folder, lake) == []
    stored = lake.read(ingest.TRIP_FILES_TABLE)
    assert stored.count() == 2
    assert dicts(stored)[0]["vendorid"] == 1 and dicts(stored)[0]["cbd_congestion_fee"] is None
    # The load died before the ledger was written: doing it again adds nothing.
    ledger = ingest.LEDGER_TABLE
    lake.reload(spark.createDataFrame([], ledger.schema), ledger)
    assert ingest.load_files(spark, folder, lake) == first
    assert lake.read(ingest.TRIP_FILES_TABLE).count() == 2


def test_jobs_of_a_bulk_load_do_not_grow_with_files(spark, lake, tmp_path):
    """Files of two kinds: as many jobs for 24 of them as for 4, and every row under its file."""

    def load(name, files):
        context, folder = spark.sparkContext, tmp_path / name
        for i in range(files):
            one = trips(spark, {"fare_amount": float(i)}).drop("row_date")
            if i % 2:
                one = one.withColumn("vendorid", one.vendorid.cast("double")).withColumnRenamed("vendorid", "VendorID").withColumn("airport_fee", one.fare_amount.cast("string"))
            one.coalesce(1).write.parquet(str(folder / f"{i:03d}"))
        context.setJobGroup(name, name)
        done = ingest.load_files(spark, str(folder), lake)
        context.setLocalProperty("spark.jobGroup.id", None)
        assert len(done) == files
        return len(context.statusTracker().getJobIdsForGroup(name))

    few, many = load("few", 4), load("many", 24)
    assert many <= few
    rows = dicts(lake.read(ingest.TRIP_FILES_TABLE))
    assert sorted(int(r["fare_amount"]) for r in rows) == sorted([*range(4), *range(24)])
    assert all(r["vendorid"] == 1 and int(r["fare_amount"]) == int(r["source_file"].split("/")[0]) for r in rows)


def test_an_ingest_in_order(spark, lake, tmp_path):
    trips(spark, {"pickup": "2024-03-01 08:00:00"}, {"pickup": "2024-03-02 08:00:00"}).drop("row_date").coalesce(1).write.parquet(str(tmp_path / "in"))
    hours, asked = TableSpec("hours", WEATHER), []
    lake.reload(weather(spark, ("2024-03-01 08:00:00", 1.0, 0.0, 50.0)), hours)

    def fetch(gaps):
        asked.extend((str(r["start"]), str(r["end"])) for r in dicts(gaps))
        times = ["2024-03-02T08:00", "2024-03-02T09:00", None]
        response = {"time": times, "temperature_2m": [3.0, 4.0, 5.0], "precipitation": [0.0] * 3, "relative_humidity_2m": [1.0] * 3, "windspeed_10m": [1.0] * 3}
        kinds = "hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>, relative_humidity_2m: array<double>, windspeed_10m: array<double>>"
        return spark.createDataFrame([(response,)], kinds)

    for _ in range(2):
        loaded = ingest.run(spark, str(tmp_path / "in"), lake, hours, fetch, "2024-06-01 00:00:00")
    assert asked == [("2024-03-02", "2024-03-02")] and loaded == []
    assert sorted((str(r["time"]), r["temperature"]) for r in dicts(lake.read(hours))) == [
        ("2024-03-01 08:00:00", 1.0), ("2024-03-02 08:00:00", 3.0), ("2024-03-02 09:00:00", 4.0)
    ]
    assert lake.read(ingest.TRIP_FILES_TABLE).count() == 2


def test_readiness(spark):
    assert recon.is_ready(spark.range(1000))
    assert not recon.is_ready(spark.range(999))
    assert recon.is_ready(spark.range(0), 0)
    [row] = dicts(recon.readiness(spark.range(999)))
    assert row == {"records": 999, "ready": False}


def test_layers(spark):
    layers = {"source": spark.range(5), "silver": spark.range(4), "gold": (spark.range(4), "id")}
    rows = {r["layer"]: (r["records"], r["difference"], r["status"]) for r in dicts(recon.compare_layers(layers, "source"))}
    assert rows == {"source": (5, 0, "match"), "silver": (4, -1, "differs"), "gold": (6, 1, "differs")}
    assert dicts(recon.verify(spark.range(1), spark.range(265)))[0]["status"] == "working"
    assert dicts(recon.verify(spark.range(0), spark.range(265)))[0]["status"] == "needs initialization"
