"""Single trips: newest first, page by page, exported.

Pages come in three ways. ``paginate`` skips rows, which costs as much as reading all pages before: for the first few pages.
``page_after`` goes on behind the last row of a page, in one pass that keeps ``page_size`` rows a task, whatever the page.
``Pages`` reads any page by its number: rows are stored once in ranges of the order, in folders with known counts, and a page
filters the one or two folders it lies in by its ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.operators import filters, params
from faretide.schemas import TableSpec
from faretide.sources import files
from faretide.sources.tables import Lake

# Stored column to the name shown.
RECENT_COLUMNS = {
    "vendorid": "vendorid",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "pulocationid": "pickup_location_id",
    "dolocationid": "dropoff_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
}


def _newest() -> list[Column]:
    return [F.desc("pickup_datetime"), *[F.col(n) for n in RECENT_COLUMNS.values() if n != "pickup_datetime"]]


def recent_trips(trips: DataFrame, limit: int = 50, hours_back: int = 24, as_of=None) -> DataFrame:
    """The newest trips of the last hours."""
    params.between("limit", limit, params.RECENT_LIMIT)
    params.between("hours_back", hours_back, params.RECENT_HOURS)
    kept = filters.window(trips, hours_back=hours_back, as_of=as_of)
    shown = kept.select(*[F.col(c).alias(n) for c, n in RECENT_COLUMNS.items()])
    return shown.orderBy(*_newest()).limit(limit)


def export_trips(
    trips: DataFrame,
    path: str,
    fmt: str = "json",
    start=None,
    end=None,
    hours_back: int | None = None,
    limit: int | None = None,
    as_of=None,
) -> None:
    """Write the trips of a date range or of the last hours to ``path``: all, or the ``limit`` newest."""
    params.one_of("format", fmt, params.FORMATS)
    if limit is not None and limit < 1:
        raise ValueError(f"limit must be 1 or more, not {limit!r}")
    kept = filters.window(trips, start, end, hours_back, as_of)
    shown = kept.select(*[F.col(c).alias(n) for c, n in RECENT_COLUMNS.items()])
    files.export(shown if limit is None else shown.orderBy(*_newest()).limit(limit), path, fmt)


def paginate(df: DataFrame, page: int, page_size: int, order_by: list[str | Column]) -> DataFrame:
    """One page in the given (total) order, with the number of rows and pages beside every row."""
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    rows = df.orderBy(*order_by).offset((page - 1) * page_size).limit(page_size)
    total = df.agg(F.count("*").alias("n")).scalar()
    return rows.withColumns(
        {
            "total_count": total,
            "page": F.lit(page),
            "page_size": F.lit(page_size),
            "total_pages": F.ceil(total / F.lit(float(page_size))).cast("bigint"),
        }
    )


def page_after(df: DataFrame, page_size: int, order_by: Sequence[str], after: Sequence[object] | None = None) -> DataFrame:
    """The next ``page_size`` rows behind the row whose ``order_by`` columns are ``after``; the first ones without.

    The columns must tell every two rows apart. They ascend, and NULL comes first.
    """
    if page_size < 1:
        raise ValueError("page_size starts at 1")
    kept = df
    if after is not None:
        if len(after) != len(order_by):
            raise ValueError("the cursor needs a value for every column of the order")
        behind, same = F.lit(False), F.lit(True)
        for name, value in zip(order_by, after):
            column, bound = F.col(name), F.lit(value).cast(df.schema[name].dataType)
            greater = column.isNotNull() if value is None else column > bound
            behind, same = behind | (same & greater), same & column.eqNullSafe(bound)
        kept = kept.filter(behind)
        if after[0] is not None:  # implied, and a bound that reaches the scan
            kept = kept.filter(F.col(order_by[0]) >= F.lit(after[0]).cast(df.schema[order_by[0]].dataType))
    return kept.orderBy(*order_by).limit(page_size)


# Rows of a folder at least, however short the ranges are: folders, their tasks and their counts are what the driver sees.
_FOLDER_ROWS = 250_000


@dataclass(frozen=True)
class Pages:
    """Rows stored in ranges of a total order, a folder for each run of ranges. ``folders``: the rows of each folder in order;
    its ranges have ``rows_per_range`` rows, the last one what is left."""

    lake: Lake
    table: TableSpec
    order_by: tuple[str, ...]
    folders: tuple[int, ...]
    rows_per_range: int

    @property
    def counts(self) -> tuple[int, ...]:
        """The rows of each range."""
        size = self.rows_per_range
        return tuple(min(size, rows - start) for rows in self.folders for start in range(0, rows, size))

    @classmethod
    def store(cls, df: DataFrame, lake: Lake, name: str, order_by: Sequence[str], rows_per_range: int = 1_000_000) -> Pages:
        """Sort ``df`` into ranges and store them as table ``name``."""
        folders = max(1, -(-df.count() // max(rows_per_range, _FOLDER_ROWS)))
        own = [T.StructField("_folder", T.IntegerType()), T.StructField("_range", T.LongType())]
        table = TableSpec(name, T.StructType([*df.schema.fields, *own]), ("_folder",), ("_range", *order_by))
        dealt = df.repartitionByRange(folders, *order_by).sortWithinPartitions(*order_by)
        # The number of a row in its partition: the lower 33 bits of this id.
        place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
        numbered = dealt.withColumn("_id", F.monotonically_increasing_id())
        lake.reload(
            numbered.withColumns({"_folder": F.shiftright("_id", 33), "_range": F.floor(place / F.lit(rows_per_range))}), table
        )
        found = {r["_folder"]: r["n"] for r in lake.read(table).groupBy("_folder").agg(F.count("*").alias("n")).collect()}
        return cls(lake, table, tuple(order_by), tuple(found.get(i, 0) for i in range(max(found, default=-1) + 1)), rows_per_range)

    def page(self, page: int, page_size: int) -> DataFrame:
        """One page, with the number of rows and pages beside every row."""
        if page < 1 or page_size < 1:
            raise ValueError("page and page_size start at 1")
        first, last = (page - 1) * page_size, page * page_size
        wanted, inside, ahead, total = [], F.lit(False), F.lit(0), 0
        for number, count in enumerate(self.folders):
            if count and total < last and total + count > first:
                low = max(first - total, 0) // self.rows_per_range
                high = (min(last - total, count) - 1) // self.rows_per_range
                here = F.col("_folder") == number
                wanted.append(number)
                inside = inside | (here & F.col("_range").between(low, high))
                before = F.col("_range") * self.rows_per_range + (total - first - 1)
                ahead = F.when(here, before).otherwise(ahead)
            total += count
        rows = self.lake.read(self.table, wanted).filter(inside)
        place = F.row_number().over(Window.partitionBy("_folder", "_range").orderBy(*self.order_by)) + ahead
        rows = rows.withColumn("_place", place).filter(F.col("_place").between(0, page_size - 1))
        facts = {"total_count": F.lit(total).cast("bigint"), "page": F.lit(page), "page_size": F.lit(page_size)}
        facts["total_pages"] = F.lit(-(-total // page_size)).cast("bigint")
        return rows.orderBy("_place").drop("_folder", "_range", "_place").withColumns(facts)
