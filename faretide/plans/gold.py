"""Gold tables.

Trips are scanned once and reduced to one row per day, hour, pickup and drop-off zone. Those rows
are reduced to one per day and zone, and the zone and borough tables are formed from these. So a
refresh reads only the silver partitions of the days that changed, and of the history only a few
hundred rows per day. Beside its averages every gold row keeps the sums behind them (``SUMS``):
coarser averages then weigh every trip the same.

``zones`` has one row per ``LocationID``. No side of a join is forced to be broadcast; Spark does
so where the size it knows allows, and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide import schemas
from faretide.functions import labels, measures
from faretide.operators import filters

SUMS = tuple(schemas.GOLD_SUMS.names)


def report_columns(gold: DataFrame) -> DataFrame:
    """A gold table without the helper sums."""
    return gold.drop(*SUMS, *schemas.GOLD_HOURLY_SUMS.names)


def _stamp(processed_time: Column | None) -> Column:
    return F.current_timestamp() if processed_time is None else processed_time


def _averages(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "avg_fare": measures.ratio(F.col("fare_sum"), F.col("fare_count")),
            "avg_distance": measures.ratio(F.col("distance_sum"), F.col("distance_count")),
        }
    )


def _totals(*extra: str) -> list[Column]:
    """Sums of rows that are sums already."""
    return [
        F.sum("trip_count").alias("trip_count"),
        measures.exact_sum(F.col("total_revenue")).alias("total_revenue"),
        measures.exact_sum(F.col("fare_sum")).alias("fare_sum"),
        F.sum("fare_count").alias("fare_count"),
        measures.exact_sum(F.col("distance_sum"), measures.DISTANCE).alias("distance_sum"),
        F.sum("distance_count").alias("distance_count"),
        *[F.sum(name).alias(name) for name in extra],
    ]


def _trip_totals() -> list[Column]:
    return [
        F.count("*").alias("trip_count"),
        measures.exact_sum(F.col("total_amount")).alias("total_revenue"),
        measures.exact_sum(F.col("fare_amount")).alias("fare_sum"),
        measures.value_count(F.col("fare_amount")).alias("fare_count"),
        measures.exact_sum(F.col("trip_distance"), measures.DISTANCE).alias("distance_sum"),
        measures.value_count(F.col("trip_distance")).alias("distance_count"),
    ]


def _boroughs(zones: DataFrame, key: str, name: str) -> DataFrame:
    return zones.select(F.col("LocationID").alias(key), F.col("Borough").alias(name))


# The sums of an hourly row: the trips' column, its decimals, and the number of values behind the sum.
_HOURLY_SUMS = {
    "total_revenue": ("total_amount", measures.MONEY, "revenue_count"),
    "fare_sum": ("fare_amount", measures.MONEY, "fare_count"),
    "distance_sum": ("trip_distance", measures.DISTANCE, "distance_count"),
    "passenger_sum": ("passenger_count", measures.MONEY, "passenger_values"),
    "tip_sum": ("tip_amount", measures.MONEY, "tip_count"),
    "tolls_sum": ("tolls_amount", measures.MONEY, "tolls_count"),
}
_HOURLY_KEY = ("metric_date", "metric_hour", "pulocationid", "dolocationid")


def _hourly_sums(trips: DataFrame, weight: Column | None = None) -> DataFrame:
    """Counts and sums per day, hour, pickup zone and drop-off zone; with ``weight`` (1 or -1) signed ones."""
    totals = [(F.count("*") if weight is None else F.sum(weight).cast("bigint")).alias("trip_count")]
    for name, (column, decimals, count) in _HOURLY_SUMS.items():
        value = F.col(column)
        known = measures.value_count(value) if weight is None else F.sum(F.when(measures.finite(value).isNotNull(), weight)).cast("bigint")
        totals += [measures.exact_sum(value, decimals, weight).alias(name), known.alias(count)]
    day, hour = F.to_date(filters.PICKUP).alias("metric_date"), F.hour(filters.PICKUP).alias("metric_hour")
    return trips.groupBy(day, hour, "pulocationid", "dolocationid").agg(*totals)


def _hourly_rows(sums: DataFrame, zones: DataFrame, processed_time: Column | None) -> DataFrame:
    named = _averages(sums).join(_boroughs(zones, "pulocationid", "borough"), "pulocationid", "left")
    return named.withColumns(
        {
            "avg_passengers": measures.ratio(F.col("passenger_sum"), F.col("passenger_values")),
            "peak_hour": labels.peak_hour(F.col("metric_hour")),
            "processed_time": _stamp(processed_time),
        }
    ).select(*schemas.GOLD_HOURLY.schema.names)


def hourly_metrics(trips: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """Trips per day, hour, pickup zone and drop-off zone."""
    return _hourly_rows(_hourly_sums(trips), zones, processed_time)


def add_images(hourly: DataFrame, images: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """Hourly rows after changes: ``images`` are trips with ``_weight`` -1 for an old version of a row, 1 for a new one.

    Sums are whole units of a measure's last decimal, so the result is that of summing up all live trips. Rows without trips go.
    """
    counts = ("trip_count", *(count for _, _, count in _HOURLY_SUMS.values()))
    both = hourly.select(*_HOURLY_KEY, *_HOURLY_SUMS, *counts).unionByName(_hourly_sums(images, F.col("_weight")))
    sums = [measures.exact_sum(F.col(name), decimals).alias(name) for name, (_, decimals, _) in _HOURLY_SUMS.items()]
    rows = both.groupBy(*_HOURLY_KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts], *sums)
    rows = rows.filter("trip_count > 0")
    rows = rows.withColumns({name: F.when(F.col(count) > 0, F.col(name)) for name, (_, _, count) in _HOURLY_SUMS.items()})
    return _hourly_rows(rows, zones, processed_time)


_REDUCED = ("trip_count", "total_revenue", *SUMS)


def _by_zone(pairs: DataFrame, *keys: str) -> DataFrame:
    """Pickup/drop-off pairs reduced to zones, both sides in one pass over the pairs.

    A pair counts for its pickup zone with all figures and for its drop-off zone as one drop-off.
    A missing zone id matches nothing, so its pickups and its drop-offs stay two rows, told apart
    by ``is_pickup``; that column is NULL for known zones.
    """
    kinds = {f.name: f.dataType for f in pairs.schema.fields}

    def side(zone: str, is_pickup: bool) -> Column:
        figures = [F.col(m) if is_pickup else F.lit(None).cast(kinds[m]).alias(m) for m in _REDUCED]
        dropoffs = F.lit(None).cast("bigint") if is_pickup else F.col("trip_count")
        apart = F.when(F.col(zone).isNull(), F.lit(is_pickup))
        return F.struct(
            F.col(zone).alias("zone_id"), apart.alias("is_pickup"), *figures, dropoffs.alias("dropoff_count")
        )

    both = pairs.select(*keys, F.inline(F.array(side("pulocationid", True), side("dolocationid", False))))
    return both.groupBy(*keys, "zone_id", "is_pickup").agg(*_totals("dropoff_count"))


def zone_daily(trips_or_hourly: DataFrame) -> DataFrame:
    """Pickups and drop-offs per pickup day and zone, from trips or from the hourly gold table."""
    if "metric_date" in trips_or_hourly.columns:
        pairs = trips_or_hourly.select("metric_date", "pulocationid", "dolocationid", *_REDUCED)
    else:
        day = F.to_date(filters.PICKUP).alias("metric_date")
        pairs = trips_or_hourly.groupBy(day, "pulocationid", "dolocationid").agg(*_trip_totals())
    return _by_zone(pairs, "metric_date").select(*schemas.GOLD_ZONE_DAILY.schema.names)


def _zone_rows(by_zone: DataFrame, zones: DataFrame, processed_time: Column | None) -> DataFrame:
    names = zones.select(
        F.col("LocationID").alias("zone_id"), F.col("Zone").alias("zone_name"), F.col("Borough").alias("borough")
    )
    return (
        _averages(by_zone)
        .join(names, "zone_id", "left")
        .withColumns(
            {
                "total_trips": F.col("trip_count"),
                "pickup_count": F.col("trip_count"),
                "last_updated": _stamp(processed_time),
            }
        )
        .select(*schemas.GOLD_ZONE.schema.names)
    )


def zone_performance(trips: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """Pickups, drop-offs, revenue and averages per zone; zones with drop-offs only have NULL pickups."""
    pairs = trips.groupBy("pulocationid", "dolocationid").agg(*_trip_totals())
    return _zone_rows(_by_zone(pairs), zones, processed_time)


def zone_performance_from_daily(daily: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """The same from the daily rows."""
    return _zone_rows(daily.groupBy("zone_id", "is_pickup").agg(*_totals("dropoff_count")), zones, processed_time)


def borough_summary(trips: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """Trips per pickup borough and day.

    ``trip_count_dropoff`` counts the trips of that pickup day which end in the borough.
    """
    return borough_summary_from_daily(zone_daily(trips), zones, processed_time)


def borough_summary_from_daily(daily: DataFrame, zones: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """The same from the daily rows."""
    rows = (
        daily.join(_boroughs(zones, "zone_id", "borough"), "zone_id", "left")
        .groupBy("borough", "metric_date")
        .agg(*_totals("dropoff_count"))
        .filter(F.col("trip_count").isNotNull())
    )
    return (
        _averages(rows)
        .withColumns(
            {
                "total_trips": F.col("trip_count"),
                "trip_count_pickup": F.col("trip_count"),
                "trip_count_dropoff": F.coalesce("dropoff_count", F.lit(0)),
                "last_updated": _stamp(processed_time),
            }
        )
        .select(*schemas.GOLD_BOROUGH.schema.names)
    )


TABLES = (schemas.GOLD_HOURLY, schemas.GOLD_ZONE_DAILY, schemas.GOLD_BOROUGH, schemas.GOLD_ZONE)


def version(lake, *of: schemas.TableSpec) -> int:
    """The version of silver that the gold tables, or some of them, hold: the oldest, where a refresh died half way."""
    return min(int(lake.snapshot(table).marks.get("silver", 0)) for table in of or TABLES)


def refresh(
    lake, silver: DataFrame, zones: DataFrame, dates: Sequence[date | None] | None = None, version: int | None = None
) -> None:
    """Bring the stored gold tables up to date with silver, which is ``version`` of its table.

    With ``dates``, the pickup days that changed, only those days of silver are read, and of the
    tables split by day only those days are replaced, days that ran empty included. Without,
    everything is. ``silver`` has the stored ``row_date`` column.
    """
    marks = None if version is None else {"silver": version}
    changed = silver if dates is None else silver.filter(F.col("row_date").isin(*dates))
    scope = lake.partition_values(schemas.GOLD_HOURLY) if dates is None else list(dates)
    lake.replace_partitions(hourly_metrics(changed, zones), schemas.GOLD_HOURLY, scope, marks)
    _form_followers(lake, zones, dates, scope, marks)


def apply_images(lake, images: DataFrame, zones: DataFrame, days: Sequence[date | str], version: int) -> None:
    """Add the images of all silver rows that changed up to ``version``; ``days`` are their pickup days.

    Of silver nothing else is read, and of gold the hourly rows of those days. The hourly table notes the version with the
    sums, so nothing is added twice; the tables formed from it may be formed again.
    """
    marks = {"silver": version}
    if not days:
        for table in TABLES:
            lake.commit(table, marks)
        return
    if _behind(lake, schemas.GOLD_HOURLY, version):
        hourly = lake.read(schemas.GOLD_HOURLY, days)
        lake.replace_partitions(add_images(hourly, images, zones), schemas.GOLD_HOURLY, days, marks)
    _form_followers(lake, zones, days, days, marks)


def _behind(lake, table: schemas.TableSpec, version: int) -> bool:
    return int(lake.snapshot(table).marks.get("silver", 0)) < version


def _form_followers(lake, zones: DataFrame, dates, scope: Sequence[date | str | None], marks) -> None:
    """The tables formed from hourly rows: per day from the days given, the all-time one from the daily rows of all days."""
    daily = zone_daily(lake.read(schemas.GOLD_HOURLY, dates)).persist()
    try:
        lake.replace_partitions(daily, schemas.GOLD_ZONE_DAILY, scope, marks)
        lake.replace_partitions(borough_summary_from_daily(daily, zones), schemas.GOLD_BOROUGH, scope, marks)
        every = daily if dates is None else lake.read(schemas.GOLD_ZONE_DAILY)
        lake.reload(zone_performance_from_daily(every, zones), schemas.GOLD_ZONE, marks)
    finally:
        daily.unpersist()
