from faretide.operators import merge
from tests.helpers import dicts


def test_latest_version_wins(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", None, 5)], "k string, v int, x int")
    assert sorted((r["k"], r["x"]) for r in dicts(merge.keep_latest(df, ["k"], ["v"]))) == [("a", 30), ("b", 5)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    latest = merge.keep_latest(df, ["k"], ["v"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    # Plans print from the result down: the partial limit stands below the shuffle.
    assert "row_number(), 1, Partial" in plan[shuffle:]
    assert latest.filter("k = 0").collect()[0]["v"] == 999


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, s string")
    deletes = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r["s"] for r in dicts(merge.apply_deletes(target, deletes, ["k"]))) == ["y", "z"]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "k int, s string")
    source = spark.createDataFrame([(1, "newer", 2), (1, "new", 1), (3, "added", 1)], "k int, s string, version int")
    result = merge.upsert(target, source, ["k"], ["version"])
    assert sorted((r["k"], r["s"]) for r in dicts(result)) == [(1, "newer"), (2, "kept"), (3, "added")]
    again = merge.upsert(result, source, ["k"], ["version"])
    assert sorted(map(str, dicts(again))) == sorted(map(str, dicts(result)))


def test_delete_and_reinsert_follow_their_order(spark):
    log = spark.createDataFrame(
        [("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("b", 2, True)],
        "k string, v int, _is_delete boolean",
    )
    assert [r["k"] for r in dicts(merge.latest_state(log, ["k"], ["v"]))] == ["a"]
