"""Versions of stored tables: readers, writers that die or meet, merges, compaction, what is deleted."""

import threading
from datetime import date

import pytest

from faretide.schemas import DATE, DOUBLE, INT, TableSpec, struct
from faretide.sources.versions import Conflict, Versions

TABLE = TableSpec("t", struct(x=INT, total=DOUBLE, day=DATE), ("day",))


def rows(spark, *values):
    return spark.createDataFrame([(x, float(t), date(2024, 1, d)) for x, t, d in values], TABLE.schema)


def contents(df):
    return sorted((r["x"], r["total"], r["day"].day) for r in df.collect())


def test_a_reader_keeps_its_version(spark, lake):
    lake.replace_partitions(rows(spark, (1, 1, 1), (2, 2, 2)), TABLE)
    before = lake.read(TABLE)
    lake.replace_partitions(rows(spark, (9, 9, 1)), TABLE, [date(2024, 1, 2)])
    assert contents(before) == [(1, 1.0, 1), (2, 2.0, 2)]
    assert contents(lake.read(TABLE)) == [(9, 9.0, 1)]
    # A table may be rewritten from itself.
    lake.reload(lake.read(TABLE).selectExpr("x + 1 AS x", "total", "day"), TABLE)
    assert contents(lake.read(TABLE)) == [(10, 9.0, 1)]


def test_a_write_that_dies_before_the_swap_does_nothing(spark, lake, monkeypatch):
    lake.replace_partitions(rows(spark, (1, 1, 1)), TABLE)
    monkeypatch.setattr(Versions, "_put", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lake.replace_partitions(rows(spark, (9, 9, 1)), TABLE)
    monkeypatch.undo()
    assert contents(lake.read(TABLE)) == [(1, 1.0, 1)]
    lake.append(rows(spark, (2, 2, 1)), TABLE)
    lake.append(rows(spark, (3, 3, 1)), TABLE)
    # What it left behind is deleted once nobody can be at work on it any more.
    assert len(lake.vacuum(TABLE, keep=1, grace_seconds=0)) == 1
    assert contents(lake.read(TABLE)) == [(1, 1.0, 1), (2, 2.0, 1), (3, 3.0, 1)]


def test_writers_at_once(spark, lake):
    lake.ensure(TABLE)
    frames = [rows(spark, (n, n, 1 + n % 2)) for n in range(6)]
    threads = [threading.Thread(target=lake.append, args=(df, TABLE)) for df in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(contents(lake.read(TABLE))) == 6 and lake.snapshot(TABLE).version == 7


def test_a_change_of_what_a_merge_read_is_a_conflict(spark, lake, monkeypatch):
    lake.replace_partitions(rows(spark, (1, 1, 1), (2, 2, 2)), TABLE)
    plain = type(lake)._stage

    def meanwhile(self, df, table):
        monkeypatch.undo()
        lake.append(rows(spark, (5, 5, 1)), TABLE)
        return plain(self, df, table)

    monkeypatch.setattr(type(lake), "_stage", meanwhile)
    with pytest.raises(Conflict):
        lake.merge(TABLE, rows(spark, (1, 7, 1)), ["x"])
    lake.merge(TABLE, rows(spark, (1, 7, 1)), ["x"])
    assert contents(lake.read(TABLE)) == [(1, 7.0, 1), (2, 2.0, 2), (5, 5.0, 1)]


def test_merge_moves_a_key_to_its_new_partition(spark, lake):
    lake.replace_partitions(rows(spark, (1, 1, 1), (2, 2, 1), (3, 3, 2), (4, 4, 3)), TABLE)
    lake.merge(TABLE, rows(spark, (1, 7, 2), (5, 5, 4)), ["x"], deletes=rows(spark, (4, 0, 9), (2, 0, 9)).select("x"))
    assert contents(lake.read(TABLE)) == [(1, 7.0, 2), (3, 3.0, 2), (5, 5.0, 4)]
    assert lake.partition_values(TABLE) == ["2024-01-02", "2024-01-04"]


def test_compaction_keeps_the_rows(spark, lake):
    for n in range(12):
        lake.append(rows(spark, (n, n, 1), (n, n, 2 + n)), TABLE)
    before = contents(lake.read(TABLE))
    assert lake.compact(TABLE, most=3) == 1
    snapshot = lake.snapshot(TABLE)
    assert contents(lake.read(TABLE)) == before and len(before) == 24
    assert all(len(writes) == 1 for writes in snapshot.leaves.values())
    assert len(lake.read(TABLE, [date(2024, 1, 1)]).inputFiles()) <= 4
    # Older versions are there until they are vacuumed, and the one read is the latest from a checkpoint on.
    old = lake.versions(TABLE).at(5)
    assert len(contents(lake.read(TABLE, at=old))) == 10
    lake.vacuum(TABLE, keep=2, grace_seconds=0)
    assert contents(lake.read(TABLE)) == before
    with pytest.raises(ValueError):
        lake.versions(TABLE).at(5)


def test_changes_as_a_stream(spark, lake, tmp_path):
    lake.replace_partitions(rows(spark, (1, 1, 1), (2, 2, 2)), TABLE)
    seen = []

    def follow():
        stream = lake.read_stream(TABLE).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        stream.trigger(availableNow=True).foreachBatch(lambda df, _: seen.append(sorted((r.version, r.leaf) for r in df.collect()))).start().awaitTermination()

    follow()
    lake.append(rows(spark, (3, 3, 2)), TABLE)
    lake.drop_partitions(TABLE, [date(2024, 1, 1)])
    follow()
    assert seen == [[(1, "day=2024-01-01"), (1, "day=2024-01-02")], [(2, "day=2024-01-02"), (3, "day=2024-01-01")]]
    assert [v.changed for v in lake.versions(TABLE).since(1)] == [("day=2024-01-02",), ("day=2024-01-01",)]
