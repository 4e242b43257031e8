from dataclasses import replace
from datetime import datetime

import pytest

from checks import views
from faretide import schemas
from faretide.operators import decode, merge, quality
from faretide.plans import gold
from faretide.sources.changes import read_cdc_stream
from faretide.sources.tables import Lake
from faretide.sources.versions import Versions
from faretide.streaming import jobs
from tests.helpers import dicts, micros, raw, record, trip_payload, zones

DAY1, DAY2 = "2024-03-01 08:00:00", "2024-03-02 08:00:00"


def trip(n=1, pickup=DAY1, **values):
    return trip_payload(pickup, f"{pickup[:11]}09:{n:02d}:00", **values)


# One line per file; the order of the files is not the order of the changes.
HISTORY = [
    record("u", trip(1), trip(1, fare_amount=11.0), ts_ms=20),
    record("c", None, trip(1), ts_ms=10),
    record("c", None, trip(2), ts_ms=10),
    record("d", trip(2), ts_ms=30),
    record("c", None, trip(3), ts_ms=10),
    record("d", trip(3), ts_ms=20),
    record("c", None, trip(3, fare_amount=33.0), ts_ms=30),
    record("c", None, trip(4), ts_ms=10),
    record("u", trip(4), trip(5, fare_amount=55.0), ts_ms=20),
    record("c", None, trip(6, fare_amount=-1.0), ts_ms=10),
    record("c", None, trip(7, DAY2), ts_ms=10),
    record("d", trip(7, DAY2), ts_ms=20),
    record("c", None, trip(8, vendorid=None), ts_ms=10),
    record("d", trip(8, vendorid=None), ts_ms=20),
    '{"op":"c","after":{"vendorid"',
]
EXPECTED = [(1, 11.0), (3, 33.0), (5, 55.0)]


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def drain(spark, folder, lake, target, checkpoint, **options):
    stream = read_cdc_stream(spark, "text", str(folder), options)
    jobs.start_changes(stream, lake, target, str(checkpoint), availableNow=True).awaitTermination()


def live(lake, target=jobs.TRIPS):
    return sorted((r["tpep_dropoff_datetime"].minute, r["fare_amount"]) for r in dicts(lake.read(target.current)))


@pytest.mark.parametrize("files_per_batch", [100, 4])
def test_stream_gives_the_same_in_one_and_in_many_batches(spark, lake, tmp_path, files_per_batch):
    for i, line in enumerate(HISTORY):
        put(tmp_path / "in", f"{i:02d}", line)
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp", maxFilesPerTrigger=files_per_batch)
    assert live(lake) == EXPECTED
    # The second day ran empty and has no directory.
    assert lake.partition_values(jobs.TRIPS.current) == ["2024-03-01"]


def test_stream_gives_the_same_as_a_batch(spark):
    changes = decode.decode_changes(raw(spark, *HISTORY), schemas.TRIP_CHANGES)
    good = quality.accept(changes.filter("NOT _is_delete"), quality.RULES["trips"])
    log = good.unionByName(changes.filter("_is_delete AND vendorid IS NOT NULL"))
    state = merge.latest_state(log, schemas.TRIP_KEY, decode.ORDER)
    assert sorted((r["tpep_dropoff_datetime"].minute, r["fare_amount"]) for r in dicts(state)) == EXPECTED


def test_every_decoded_change_is_accounted_for(spark):
    changes = decode.decode_changes(raw(spark, *HISTORY), schemas.TRIP_CHANGES)
    upserts, rules = changes.filter("NOT _is_delete"), quality.RULES["trips"]
    parts = [quality.accept(upserts, rules), quality.reject(upserts, rules), changes.filter("_is_delete")]
    assert sum(p.count() for p in parts) == changes.count() == len(HISTORY)  # one cut off, one split in two


def test_instalments_form_their_own_records_only(spark, tmp_path):
    """The parts are all records, each once; what belongs to another part goes before any text is formed."""
    times = "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)"
    columns = ("id AS event_id", f"{times} AS ts", "id % 9 AS user_id", "'view' AS event_type", "id / 2D AS value", "'{\"k\": 3}' AS props")
    spark.range(300).selectExpr(*columns).write.parquet(str(tmp_path / "events.parquet"))
    every = views.trip_changes(spark, str(tmp_path))
    parts = [views.trip_changes(spark, str(tmp_path), 3, part) for part in range(3)]
    texts = [sorted(r["value"] for r in dicts(part)) for part in parts]
    assert all(texts) and sorted(sum(texts, [])) == sorted(r["value"] for r in dicts(every))
    plan = parts[0]._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(event_id")
    assert "to_json" not in plan[exchange:] and "xxhash64" in plan[exchange:]


def test_a_replayed_batch_changes_nothing(spark, lake):
    target = jobs.TRIPS
    write = jobs.apply_batch(lake, target)
    first, second = raw(spark, *HISTORY[:7]), raw(spark, *HISTORY[7:])
    for batch_id, batch in ((0, first), (1, second), (1, second), (0, first)):
        write(jobs.checked_changes(batch, target.spec), batch_id)
    assert live(lake) == EXPECTED
    assert lake.read(target.log).count() == 8
    assert lake.read(target.deletes).count() == 4
    write(jobs.checked_changes(raw(spark, record("t")), target.spec), 2)  # nothing in it
    jobs.rebuild(lake, target)
    assert live(lake) == EXPECTED


def test_restart_goes_on_from_the_checkpoint(spark, lake, tmp_path):
    put(tmp_path / "in", "a", *HISTORY[:6])
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp")
    put(tmp_path / "in", "b", *HISTORY[6:])
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp")
    assert live(lake) == EXPECTED
    marks = lake.snapshot(jobs.TRIPS.state).marks
    assert (marks["batch:main"], marks["run:main"]) == (1, 0)


def test_new_checkpoint_under_a_new_name_keeps_the_log(spark, lake, tmp_path):
    put(tmp_path / "in", "a", *HISTORY)
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp1")
    drain(spark, tmp_path / "in", lake, replace(jobs.TRIPS, run="second"), tmp_path / "cp2")
    assert live(lake) == EXPECTED


def test_without_commit_times_the_later_batch_wins(spark, lake):
    target = jobs.TRIPS
    write = jobs.apply_batch(lake, target)
    write(jobs.checked_changes(raw(spark, record("c", None, trip(1)), record("d", trip(1))), target.spec), 0)
    assert live(lake) == []
    write(jobs.checked_changes(raw(spark, record("c", None, trip(1, fare_amount=2.0))), target.spec), 1)
    assert live(lake) == [(1, 2.0)]


def state_of(spark, *records):
    """The live fares after records (value, partition, offset, timestamp), by drop-off minute."""
    df = spark.createDataFrame(records, "value string, partition int, offset long, timestamp timestamp")
    changes = decode.decode_changes(df, schemas.TRIP_CHANGES)
    state = merge.latest_state(changes, schemas.TRIP_KEY, decode.ORDER)
    return sorted((r["tpep_dropoff_datetime"].minute, r["fare_amount"]) for r in dicts(state))


def fare(amount, op="u", **more):
    return record(op, trip(1), trip(1, fare_amount=amount), **more)


def test_order_over_partitions_of_the_source(spark):
    # Offsets of two partitions say nothing about each other: the commit time does.
    assert state_of(spark, (fare(1.0, ts_ms=5), 0, 900, None), (fare(2.0, ts_ms=6), 1, 3, None)) == [(1, 2.0)]
    # The position in the source's log comes before its clock, and within one partition the offset decides.
    early, late = {"lsn": 70, "ts_ms": 9}, {"lsn": 100, "ts_ms": 8}
    assert state_of(spark, (fare(1.0, ts_ms=9, source=early), 0, 8, None), (fare(2.0, ts_ms=8, source=late), 0, 7, None)) == [(1, 2.0)]
    assert state_of(spark, (fare(1.0, ts_ms=5), 1, 10, None), (fare(2.0, ts_ms=5), 1, 9, None)) == [(1, 1.0)]


def test_order_without_a_commit_time(spark):
    at = datetime(2024, 3, 1, 12, 0, 0)
    late = int(at.timestamp() * 1000) + 1
    # Counted from when the source, or else the broker, saw the record.
    assert state_of(spark, (fare(1.0), 0, 1, at), (fare(2.0, source={"ts_ms": late}), 0, 0, None)) == [(1, 2.0)]
    assert state_of(spark, (fare(1.0), 0, 1, at), (fare(2.0, ts_ms=late - 2), 0, 0, None)) == [(1, 1.0)]
    # With nothing of it the offset is left, and then life cycle.
    assert state_of(spark, (fare(1.0), 0, 2, None), (fare(2.0), 0, 1, None)) == [(1, 1.0)]
    assert state_of(spark, (fare(1.0), None, None, None), (record("d", trip(1)), None, None, None)) == []


def test_runs_are_numbered_as_they_come(spark, lake):
    for name, amount in (("a2", 1.0), ("a10", 2.0)):
        write = jobs.apply_batch(lake, replace(jobs.TRIPS, run=name))
        write(jobs.checked_changes(raw(spark, fare(amount)), schemas.TRIP_CHANGES), 0)
    assert live(lake) == [(1, 2.0)]
    # The older run again, with a later batch of its own: it is still the older run.
    jobs.apply_batch(lake, replace(jobs.TRIPS, run="a2"))(jobs.checked_changes(raw(spark, fare(3.0)), schemas.TRIP_CHANGES), 7)
    assert live(lake) == [(1, 2.0)]


def test_a_batch_reads_its_buckets_only(spark, lake):
    """Over 20 batches, what a batch reads does not grow with what came before."""
    target = replace(jobs.TRIPS, buckets=4)
    write, read = jobs.apply_batch(lake, target), []
    plain = Lake.read_leaves

    def counted(self, table, at, below):
        df = plain(self, table, at, below)
        read.append((len(df.inputFiles()), df.count()))
        return df

    Lake.read_leaves = counted
    try:
        for n in range(20):
            lines = [fare(float(n), ts_ms=n), *(record("c", None, trip(k, f"2024-04-{n + 1:02d} 08:00:00"), ts_ms=n) for k in range(3))]
            write(jobs.checked_changes(raw(spark, *lines), target.spec), n)
    finally:
        Lake.read_leaves = plain
    assert live(lake, target)[0] != [] and lake.read(target.current).count() == 61
    assert all(files <= 2 and rows <= 1 for files, rows in read) and len(read) == 20
    assert lake.read(target.log).count() == 80


def test_rejects_and_accepted_are_all_that_was_read(spark, lake):
    write = jobs.apply_batch(lake, jobs.TRIPS)
    write(jobs.checked_changes(raw(spark, *HISTORY[:8]), jobs.TRIPS.spec), 0)
    write(jobs.checked_changes(raw(spark, *HISTORY[8:]), jobs.TRIPS.spec), 1)
    write(jobs.checked_changes(raw(spark, *HISTORY[8:]), jobs.TRIPS.spec), 1)
    rejects = [(r["reject_reasons"], r["_record"], r["_batch"]) for r in dicts(lake.read(jobs.TRIPS.rejects))]
    assert sorted(rejects, key=str) == [
        (["fare negative"], None, 1),
        (["key missing"], None, 1),
        (["no change record"], HISTORY[14], 1),
        (["vendor missing"], None, 1),
    ]
    marks = lake.snapshot(jobs.TRIPS.state).marks
    assert (marks["read"], marks["accepted"], marks["rejected"]) == (8, 4, 4)
    assert lake.read(jobs.TRIPS.log).count() + lake.read(jobs.TRIPS.deletes).count() + len(rejects) == len(HISTORY) + 1


def test_a_batch_that_died_between_tables_is_completed(spark, lake, monkeypatch):
    write, changes = jobs.apply_batch(lake, jobs.TRIPS), jobs.checked_changes(raw(spark, *HISTORY), jobs.TRIPS.spec)
    plain = Versions.commit

    def dies(self, change, *rest, **more):
        if self.path.endswith("deletes"):
            raise OSError("lost")
        return plain(self, change, *rest, **more)

    monkeypatch.setattr(Versions, "commit", dies)
    with pytest.raises(OSError):
        write(changes, 0)
    assert live(lake) == [] and lake.read(jobs.TRIPS.log).count() == 8
    monkeypatch.undo()
    write(changes, 0)
    assert live(lake) == EXPECTED
    assert lake.read(jobs.TRIPS.log).count() == 8 and lake.read(jobs.TRIPS.deletes).count() == 4


def test_expired_partitions_stay_away(spark, lake):
    write = jobs.apply_batch(lake, jobs.TRIPS)
    write(jobs.checked_changes(raw(spark, fare(1.0, ts_ms=1), record("c", None, trip(2, "2024-05-01 08:00:00"), ts_ms=1)), jobs.TRIPS.spec), 0)
    assert jobs.expire(lake, jobs.TRIPS, 30, datetime(2024, 5, 15)) == ["2024-03-01"]
    late = record("c", None, trip(5, "2024-03-02 08:00:00"), ts_ms=9)
    write(jobs.checked_changes(raw(spark, fare(2.0, ts_ms=9), late, record("u", trip(2), trip(2, "2024-05-01 08:00:00", fare_amount=7.0), ts_ms=9)), jobs.TRIPS.spec), 1)
    assert live(lake) == [(2, 7.0)]
    reasons = [r["reject_reasons"] for r in dicts(lake.read(jobs.TRIPS.rejects))]
    # The update of trip 2 deletes its old key too, which lies in the expired day.
    assert reasons == [["partition expired"]] * 3
    jobs.rebuild(lake, jobs.TRIPS)
    assert live(lake) == [(2, 7.0)]


def test_files_and_versions_stay_bounded(spark, lake):
    write = jobs.apply_batch(lake, jobs.TRIPS, most_writes=4)
    for n in range(15):
        write(jobs.checked_changes(raw(spark, fare(float(n), ts_ms=n)), jobs.TRIPS.spec), n)
    jobs.maintain(lake, jobs.TRIPS, 4, keep=5)
    assert lake.read(jobs.TRIPS.log).count() == 15 and live(lake) == [(1, 14.0)]
    assert all(len(w) <= 4 for w in lake.snapshot(jobs.TRIPS.log).leaves.values())
    numbers = lake.versions(jobs.TRIPS.state)._numbers("json")
    assert len(numbers) <= 5 and max(numbers) >= 15
    assert lake.versions(jobs.TRIPS.state).since(0) is None


def test_source_offsets_order_changes(spark):
    df = spark.createDataFrame(
        [(record("c", None, trip(1, fare_amount=1.0)), 5), (record("u", None, trip(1, fare_amount=2.0)), 4)],
        "value string, offset long",
    )
    state = merge.latest_state(decode.decode_changes(df, schemas.TRIP_CHANGES), schemas.TRIP_KEY, decode.ORDER)
    assert [r["fare_amount"] for r in dicts(state)] == [1.0]


def test_weather_stream(spark, lake, tmp_path):
    def hour(h, temperature):
        return {"time": micros(f"2024-03-01 {h:02d}:00:00"), "temperature": temperature, "humidity": 50}

    put(
        tmp_path / "in",
        "a",
        record("c", None, hour(1, 10.0), ts_ms=1),
        record("u", hour(1, 10.0), hour(1, 12.5), ts_ms=2),
        record("c", None, hour(2, 101.0), ts_ms=1),
        record("c", None, hour(3, 5.0), ts_ms=1),
        record("d", hour(3, 5.0), None, ts_ms=2),
        record("u", None, None, ts_ms=3),
    )
    drain(spark, tmp_path / "in", lake, jobs.WEATHER, tmp_path / "cp")
    assert [(r["time"].hour, r["temperature"], r["_operation"]) for r in dicts(lake.read(jobs.WEATHER.current))] == [
        (1, 12.5, "u")
    ]
    assert lake.partition_values(jobs.WEATHER.current) == ["202403"]


def test_live_tables_beside_the_lakehouse(spark, lake, tmp_path):
    put(tmp_path / "in", "a", *HISTORY)
    put(tmp_path / "zones", "a", record("r", None, {"LocationID": 1, "Borough": "EWR", "Zone": "Newark"}))
    drain(spark, tmp_path / "in", lake, jobs.LIVE_TRIPS, tmp_path / "cp1")
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp2")
    drain(spark, tmp_path / "zones", lake, jobs.LIVE_ZONES, tmp_path / "cp3")
    # Own key (pickup, zone, vendor), no deletes, no quality rules, zeros for what is missing.
    rows = {(r["row_month"], r["vendorid"], r["tpep_pickup_datetime"].day) for r in dicts(lake.read(jobs.LIVE_TRIPS.current))}
    assert rows == {("202403", 1, 1), ("202403", 1, 2), ("202403", 0, 1)}
    assert live(lake) == EXPECTED
    assert dicts(lake.read(jobs.LIVE_ZONES.current))[0]["service_zone"] == ""


def test_gold_follows_silver_commits(spark, lake, tmp_path):
    folder, z = tmp_path / "in", zones(spark, (10, "Queens", "Astoria"))

    def step(name, *lines):
        put(folder, name, *lines)
        drain(spark, folder, lake, jobs.TRIPS, tmp_path / "cp")
        jobs.start_gold(lake, lambda: z, str(tmp_path / "gold"), backfill=False, availableNow=True).awaitTermination()
        return sorted(
            (str(r["metric_date"]), r["trip_count"], r["total_revenue"]) for r in dicts(lake.read(schemas.GOLD_HOURLY))
        )

    assert step("a", record("c", None, trip(1), ts_ms=1), record("c", None, trip(2, DAY2), ts_ms=1)) == [
        ("2024-03-01", 1, 12.0),
        ("2024-03-02", 1, 12.0),
    ]
    # A late correction of the first day, and the second day's only trip is deleted.
    late = record("u", trip(1), trip(1, total_amount=20.5), ts_ms=2)
    assert step("b", late, record("d", trip(2, DAY2), ts_ms=2)) == [("2024-03-01", 1, 20.5)]
    assert [r["total_trips"] for r in dicts(lake.read(schemas.GOLD_BOROUGH))] == [1]


def gold_rows(lake, table):
    drop = {"processed_time", "last_updated"}
    return sorted(str({k: v for k, v in r.items() if k not in drop}) for r in dicts(lake.read(table)))


def test_gold_by_images_is_gold_anew(spark, lake, tmp_path):
    """Updates, moved keys, late deletes, missing measures, and a day that runs empty; after each instalment."""
    z = zones(spark, (10, "Queens", "Astoria"), (20, "Bronx", "Fordham"), (30, "Bronx", "Kingsbridge"))
    missing = {"fare_amount": None, "tip_amount": None, "tolls_amount": None, "passenger_count": None, "trip_distance": None}
    steps = [
        [record("c", None, trip(n, pulocationid=10 * (n % 3 + 1), total_amount=n + 0.1), ts_ms=1) for n in range(1, 9)],
        [record("c", None, trip(9, **missing), ts_ms=1), record("u", trip(1), trip(1, **missing), ts_ms=2), record("c", None, trip(3, DAY2), ts_ms=1)],
        [record("u", trip(2), trip(2, DAY2), ts_ms=3), record("d", trip(9), ts_ms=4), record("d", trip(4), ts_ms=0)],
        [record("u", trip(3, DAY2), trip(3, DAY2, pulocationid=None), ts_ms=5), record("u", trip(1), trip(1, fare_amount=3.25), ts_ms=6)],
        [record("d", trip(3, DAY2), ts_ms=7), record("d", trip(2, DAY2), ts_ms=7), record("d", trip(5), ts_ms=7)],
    ]
    write = jobs.apply_batch(lake, jobs.TRIPS)
    for n, lines in enumerate(steps):
        write(jobs.checked_changes(raw(spark, *lines), jobs.TRIPS.spec), n)
        jobs.follow_silver(lake, z)
        other = Lake(spark, str(tmp_path / f"other{n}"))
        gold.refresh(other, lake.read(jobs.TRIPS.current), z)
        for table in gold.TABLES:
            assert gold_rows(lake, table) == gold_rows(other, table), (n, table.name)
    assert gold.version(lake) == lake.snapshot(jobs.TRIPS.state).version
    assert lake.partition_values(schemas.GOLD_HOURLY) == ["2024-03-01"]


def test_gold_reads_no_silver_day_again(spark, lake, monkeypatch):
    z = zones(spark)
    write = jobs.apply_batch(lake, jobs.TRIPS)
    write(jobs.checked_changes(raw(spark, *HISTORY), jobs.TRIPS.spec), 0)
    jobs.follow_silver(lake, z)
    write(jobs.checked_changes(raw(spark, record("u", trip(1), trip(1, total_amount=99.0), ts_ms=99)), jobs.TRIPS.spec), 1)
    read, plain = [], Lake._read_paths
    monkeypatch.setattr(Lake, "_read_paths", lambda self, table, paths: (read.append((table.name, paths)), plain(self, table, paths))[1])
    jobs.follow_silver(lake, z)
    silver = [path for name, paths in read if name == jobs.TRIPS.current_name for path in paths]
    assert silver and all(path.endswith("_kind=changed") for path in silver)
    assert sum(r["total_revenue"] for r in dicts(lake.read(schemas.GOLD_HOURLY))) == 99.0 + 12.0 * 2


def test_gold_that_died_half_way_adds_nothing_twice(spark, lake, monkeypatch):
    z = zones(spark)
    write = jobs.apply_batch(lake, jobs.TRIPS)
    write(jobs.checked_changes(raw(spark, *HISTORY), jobs.TRIPS.spec), 0)
    plain = gold._form_followers
    monkeypatch.setattr(gold, "_form_followers", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.follow_silver(lake, z)
    write(jobs.checked_changes(raw(spark, record("c", None, trip(8), ts_ms=99)), jobs.TRIPS.spec), 1)
    monkeypatch.setattr(gold, "_form_followers", plain)
    jobs.follow_silver(lake, z)
    assert sum(r["trip_count"] for r in dicts(lake.read(schemas.GOLD_HOURLY))) == 4
    assert sum(r["total_trips"] or 0 for r in dicts(lake.read(schemas.GOLD_ZONE))) == 4
    jobs.rebuild(lake, jobs.TRIPS)  # formed anew: gold is too
    jobs.follow_silver(lake, z)
    assert sum(r["trip_count"] for r in dicts(lake.read(schemas.GOLD_HOURLY))) == 4


def test_gold_waits_for_enough_silver(spark, lake, tmp_path):
    z = zones(spark)
    with pytest.raises(RuntimeError):
        jobs.start_gold(lake, lambda: z, str(tmp_path / "gold"), availableNow=True)
    put(tmp_path / "in", "a", *HISTORY)
    drain(spark, tmp_path / "in", lake, jobs.TRIPS, tmp_path / "cp")
    jobs.start_gold(lake, lambda: z, str(tmp_path / "gold"), min_rows=3, availableNow=True).awaitTermination()
    assert sum(r["trip_count"] for r in dicts(lake.read(schemas.GOLD_HOURLY))) == 3
