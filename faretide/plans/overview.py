"""Headline statistics of a period."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faretide.functions import clock, labels, measures
from faretide.operators import filters

TOP_K = 5
# Zones are ranked within this many hash buckets first, so that the list the final aggregate
# gathers holds at most BUCKETS * k entries however many zone ids the data has.
BUCKETS = 32


def _per_zone(trips: DataFrame, *keys: Column) -> DataFrame:
    return trips.groupBy("pulocationid", *keys).agg(
        F.count("*").alias("trips"),
        measures.exact_sum(F.col("total_amount")).alias("revenue"),
        measures.exact_sum(F.col("fare_amount")).alias("fare_sum"),
        measures.value_count(F.col("fare_amount")).alias("fare_count"),
    )


def _zone_names(zones: DataFrame) -> DataFrame:
    return zones.select(F.col("LocationID").alias("pulocationid"), F.col("Zone"))


def _named(per_zone: DataFrame, zones: DataFrame) -> DataFrame:
    named = per_zone.join(_zone_names(zones), "pulocationid", "left")
    return named.withColumn("zone_name", labels.zone_label(F.col("pulocationid"), F.col("Zone"))).drop("Zone")


def _head_list(k: int) -> Column:
    """The k busiest of the bucket leaders, as an array of structs."""
    leader = F.struct(
        (-F.col("trips")).alias("order"), F.col("pulocationid"), F.col("zone_name"), F.col("trips"), F.col("revenue")
    )
    leaders = F.sort_array(F.collect_list(F.when(F.col("place") <= k, leader)))
    return F.transform(F.slice(leaders, 1, k), lambda z: F.struct(z.zone_name, z.trips, z.revenue))


def latest_weather(weather: DataFrame, as_of=None) -> DataFrame:
    """The last weather row at or before ``as_of``; no row if there is none."""
    seen = weather.filter(F.col("time") <= clock.moment(as_of))
    return seen.orderBy(F.desc("time"), "temperature", "humidity", "precipitation").limit(1).select(
        "time", "temperature", "humidity", "precipitation"
    )


def _weather_columns(weather: DataFrame | None, as_of) -> dict[str, Column]:
    names = ("temperature", "humidity", "precipitation")
    if weather is None:
        return {}
    latest = latest_weather(weather, as_of).select(F.struct(*names).alias("w")).scalar()
    return {
        n: F.coalesce(measures.finite(latest.getField(n)).cast("double"), F.lit(0.0)) for n in names
    }


def dashboard_stats(
    trips: DataFrame,
    zones: DataFrame,
    weather: DataFrame | None = None,
    start=None,
    end=None,
    hours_back: int | None = None,
    as_of=None,
    k: int = TOP_K,
) -> DataFrame:
    """One row: trips, revenue, mean fare, active zones, the busiest zones and the latest weather.

    Totals and ranking come from the same pass over the trips. An empty period gives zeros.
    """
    per_zone = _named(_per_zone(filters.window(trips, start, end, hours_back, as_of)), zones)
    bucket = F.pmod(F.hash("pulocationid"), F.lit(BUCKETS))
    order = Window.partitionBy(bucket).orderBy(F.desc("trips"), "pulocationid")
    totals = per_zone.withColumn("place", F.row_number().over(order)).agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
        F.coalesce(measures.exact_sum(F.col("revenue")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(measures.ratio(measures.exact_sum(F.col("fare_sum")), F.sum("fare_count")), F.lit(0.0)).alias(
            "avg_fare"
        ),
        F.count("pulocationid").alias("active_zones"),
        _head_list(k).alias("top_zones"),
    )
    return totals.withColumns({"peak_hour": F.lit("N/A"), **_weather_columns(weather, as_of)})


def top_zones(
    trips: DataFrame, zones: DataFrame, k: int = TOP_K, start=None, end=None, hours_back: int | None = None, as_of=None
) -> DataFrame:
    """The k zones with most pickups; the lower zone id first among equals."""
    per_zone = _per_zone(filters.window(trips, start, end, hours_back, as_of)).select(
        "pulocationid", "trips", "revenue"
    )
    head = per_zone.orderBy(F.desc("trips"), "pulocationid").limit(k)
    return _named(head, zones).orderBy(F.desc("trips"), "pulocationid").select("zone_name", "trips", "revenue")


def active_zones(
    trips: DataFrame, start=None, end=None, hours_back: int | None = None, as_of=None, approximate: bool = False
) -> DataFrame:
    """Number of distinct pickup zones."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    kept = filters.window(trips, start, end, hours_back, as_of)
    return kept.agg(count("pulocationid").alias("active_zones"))


def active_zones_from_gold(zone_daily: DataFrame, start=None, end=None) -> DataFrame:
    """Number of distinct pickup zones of a range of days, exactly, from the daily gold rows (one a day and zone)."""
    kept = zone_daily.filter(filters.days("metric_date", start, end)).filter("trip_count > 0")
    return kept.agg(F.countDistinct("zone_id").alias("active_zones"))


def stats_from_gold(
    borough_gold: DataFrame, zone_gold: DataFrame, start=None, end=None, k: int = TOP_K, zone_daily: DataFrame | None = None
) -> DataFrame:
    """Headline statistics from gold tables. Only the totals follow the dates, and with ``zone_daily`` the active zones.

    The mean fare weighs every trip the same (a mean of daily means would not). The zone table, one row a zone, is read once.
    """
    totals = borough_gold.filter(filters.days("metric_date", start, end)).agg(
        F.coalesce(F.sum("total_trips"), F.lit(0)).alias("total_trips"),
        F.coalesce(measures.exact_sum(F.col("total_revenue")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(measures.ratio(measures.exact_sum(F.col("fare_sum")), F.sum("fare_count")), F.lit(0.0)).alias(
            "avg_fare"
        ),
    )
    order = Window.partitionBy(F.pmod(F.hash("zone_id"), F.lit(BUCKETS))).orderBy(F.desc_nulls_last("total_trips"), "zone_id")
    entry = F.struct(
        F.col("total_trips").isNull().alias("without"),
        (-F.coalesce("total_trips", F.lit(0))).alias("order"),
        "zone_id",
        "zone_name",
        F.col("total_trips").alias("trips"),
        F.col("total_revenue").alias("revenue"),
    )
    leaders = F.sort_array(F.collect_list(F.when(F.col("place") <= k, entry)))
    listed = zone_gold.withColumn("place", F.row_number().over(order)).agg(
        F.struct(
            F.count("zone_id").alias("active_zones"),
            F.transform(F.slice(leaders, 1, k), lambda z: F.struct(z.zone_name, z.trips, z.revenue)).alias("top_zones"),
        ).alias("zones")
    )
    told = totals.withColumn("zones", listed.scalar())
    active = F.col("zones.active_zones") if zone_daily is None else active_zones_from_gold(zone_daily, start, end).scalar()
    return told.select("total_trips", "total_revenue", "avg_fare", active.alias("active_zones"), F.col("zones.top_zones").alias("top_zones"))


def stats_with_delta(trips: DataFrame, start, end) -> DataFrame:
    """Statistics of a period, of the period of equal length before it, and the differences."""
    first, last = filters.as_day(start), filters.as_day(end)
    if first is None or last is None or last < first:
        raise ValueError("a period needs a start and an end, in that order")
    before = first - timedelta(days=(last - first).days + 1)
    is_current = F.col(filters.PICKUP) >= clock.moment(str(first))
    per_zone = _per_zone(filters.window(trips, before, last), is_current.alias("is_current"))

    def totals(current: bool, prefix: str) -> list[Column]:
        def only(name: str) -> Column:
            return F.when(F.col("is_current") == F.lit(current), F.col(name))

        mean = measures.ratio(measures.exact_sum(only("fare_sum")), F.sum(only("fare_count")))
        return [
            F.coalesce(F.sum(only("trips")), F.lit(0)).alias(f"{prefix}total_trips"),
            F.coalesce(measures.exact_sum(only("revenue")), F.lit(0.0)).alias(f"{prefix}total_revenue"),
            F.coalesce(mean, F.lit(0.0)).alias(f"{prefix}avg_fare"),
            F.count(only("pulocationid")).alias(f"{prefix}active_zones"),
        ]

    both = per_zone.agg(*totals(True, ""), *totals(False, "prev_"))
    names = ("total_trips", "total_revenue", "avg_fare", "active_zones")
    return both.withColumns({f"{n}_delta": F.col(n) - F.col(f"prev_{n}") for n in names})
