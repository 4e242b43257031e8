"""Reports per pickup zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.functions import labels, measures
from faretide.operators import filters, params


def trips_with_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Every trip with the borough of its pickup zone; NULL where the zone is unknown."""
    names = zones.select(F.col("LocationID").alias("pulocationid"), F.col("Borough").alias("pu_borough"))
    return trips.join(names, "pulocationid", "left").select(*trips.columns, "pu_borough")


def zone_performance(
    trips: DataFrame,
    zones: DataFrame,
    start=None,
    end=None,
    limit: int | None = None,
    hours_back: int | None = None,
    boroughs: str | list[str] | None = None,
    as_of=None,
) -> DataFrame:
    """Pickups, revenue and averages per zone, busiest first.

    ``dropoffs`` counts the zone's trips that end in another zone. With ``boroughs`` only zones
    of those boroughs remain.
    """
    params.between("limit", limit, params.ZONE_LIMIT)
    per_zone = (
        filters.window(trips, start, end, hours_back, as_of)
        .groupBy("pulocationid")
        .agg(
            F.count("*").alias("pickups"),
            measures.exact_sum(F.col("total_amount")).alias("revenue"),
            measures.exact_mean(F.col("fare_amount")).alias("avg_fare"),
            measures.exact_mean(F.col("trip_distance"), measures.DISTANCE).alias("distance"),
            F.count_if(F.col("dolocationid") != F.col("pulocationid")).alias("dropoffs"),
        )
    )
    named = per_zone.join(zones, per_zone.pulocationid == zones.LocationID, "left")
    wanted = params.borough_list(boroughs)
    if wanted:
        named = named.filter(F.col("Borough").isin(*wanted))
    report = named.orderBy(F.desc("pickups"), "pulocationid").select(
        F.col("pulocationid").alias("zone_id"),
        labels.zone_label(F.col("pulocationid"), F.col("Zone")).alias("zone_name"),
        labels.borough_label(F.col("Borough")).alias("borough"),
        "pickups",
        "revenue",
        "avg_fare",
        "distance",
        "dropoffs",
    )
    return report if limit is None else report.limit(limit)


def zones_from_gold(
    zone_gold: DataFrame, boroughs: str | list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """The zone report from the gold table, over its whole period."""
    params.between("limit", limit, params.ZONE_LIMIT)
    wanted = params.borough_list(boroughs)
    kept = zone_gold.filter(F.col("borough").isin(*wanted)) if wanted else zone_gold
    report = kept.orderBy(F.desc_nulls_last("total_trips"), "zone_id").select(
        "zone_id",
        "zone_name",
        "borough",
        F.col("total_trips").alias("pickups"),
        F.col("total_revenue").alias("revenue"),
        "avg_fare",
        F.col("avg_distance").alias("distance"),
    )
    return report if limit is None else report.limit(limit)


def charted(report: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` zones of a report for a chart: ``pickups`` shown as ``trips``, and ``size``, the mean fare, never below 0."""
    head = report.limit(k)
    return head.withColumnRenamed("pickups", "trips").withColumn("size", measures.at_least(F.col("avg_fare"), 0))
