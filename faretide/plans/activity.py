"""What is going on now: last hour per zone, and the demand expected next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.functions import clock, labels, measures
from faretide.operators import filters

FORECAST_DAYS = 7


def _busiest(per_zone: DataFrame, zones: DataFrame, count: str, k: int | None) -> DataFrame:
    """The k busiest zones, or all of them, with their names."""
    head = per_zone if k is None else per_zone.orderBy(F.desc(count), "pulocationid").limit(k)
    named = head.join(zones.select("LocationID", "Zone"), F.col("pulocationid") == F.col("LocationID"), "left")
    return named.withColumn("zone_name", labels.zone_label(F.col("pulocationid"), F.col("Zone"))).orderBy(
        F.desc(count), "pulocationid"
    )


def demand_forecast(
    trips: DataFrame, zones: DataFrame, as_of=None, seed: int = 0, k: int | None = None
) -> DataFrame:
    """Trips per zone in the last week with a tenth added, busiest first; all zones, or the first k.

    ``confidence_score`` and ``weather_impact_factor`` are random placeholders, as in the service
    this report stands for; ``seed`` fixes them.
    """
    now = clock.moment(as_of)
    recent = filters.window(trips, hours_back=24 * FORECAST_DAYS, as_of=as_of)
    per_zone = recent.groupBy("pulocationid").agg(F.count("*").alias("historical_avg"))
    ahead = now + F.make_dt_interval(F.lit(0), F.lit(1))
    grown = F.round(F.col("historical_avg").cast("decimal(20,0)") * F.expr("1.1BD"), 0).cast("double")
    return _busiest(per_zone, zones, "historical_avg", k).select(
        F.col("pulocationid").alias("location_id"),
        "zone_name",
        ahead.alias("prediction_hour"),
        grown.alias("predicted_demand"),
        F.round(F.lit(0.7) + F.rand(seed) * 0.25, 3).alias("confidence_score"),
        F.round(F.lit(0.9) + F.rand(seed + 1) * 0.2, 2).alias("weather_impact_factor"),
        "historical_avg",
    )


def forecast_confidence(forecast: DataFrame) -> DataFrame:
    return forecast.agg(F.avg("confidence_score").alias("avg_confidence"))


def realtime_activity(
    trips: DataFrame, zones: DataFrame, as_of=None, hours: int = 1, k: int | None = None
) -> DataFrame:
    """The zones of the last hour, busiest first; all, or the first k. Half the mean distance stands in for a waiting time."""
    now = clock.moment(as_of)
    per_zone = (
        filters.window(trips, hours_back=hours, as_of=as_of)
        .groupBy("pulocationid")
        .agg(
            F.count("*").alias("pickup_count"),
            measures.exact_sum(F.col("total_amount")).alias("revenue_last_hour"),
            measures.rounded(measures.exact_mean(F.col("trip_distance"), measures.DISTANCE) / F.lit(2.0), 1).alias("avg_wait_time"),
        )
    )
    return _busiest(per_zone, zones, "pickup_count", k).select(
        F.col("pulocationid").alias("zone_id"),
        "zone_name",
        now.alias("timestamp"),
        (F.col("pickup_count") / F.lit(10.0)).alias("activity_score"),  # count / 100 * 10
        "pickup_count",
        "revenue_last_hour",
        "avg_wait_time",
    )


def activity_totals(activity: DataFrame) -> DataFrame:
    """One row over the activity report; for totals of all zones, that report must hold them all (no ``k``)."""
    return activity.agg(
        F.count("*").alias("active_zones"),
        F.coalesce(F.sum("pickup_count"), F.lit(0)).alias("total_pickups"),
        F.coalesce(measures.exact_sum(F.col("revenue_last_hour")), F.lit(0.0)).alias("revenue"),
        measures.exact_mean(F.col("activity_score"), measures.FINE).alias("avg_activity"),
    )
