import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faretide import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        # Many small queries, each run once: the slow compiler does not pay off.
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from faretide.sources.tables import Lake

    return Lake(spark, str(tmp_path / "lake"))
