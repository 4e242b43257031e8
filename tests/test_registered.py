"""Every registered query against its SQL, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as entry
from checks import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_same_as_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # The smallest tables have days without any trip, so a result may be empty there.
    assert compare.compare(spark, con, FOLDER, name, df) in (None, "both empty")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "metric_date"


def test_keys_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
