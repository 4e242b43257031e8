"""Time series of a metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.functions import clock, labels, measures
from faretide.operators import filters, params


def _points(grouped, value: Column, metric: str, interval: str) -> DataFrame:
    points = grouped.agg(value.cast("double").alias("values"))
    keys = [c for c in ("bucket_day", "bucket_hour") if c in points.columns]
    hour = F.col("bucket_hour") if "bucket_hour" in keys else None
    return points.orderBy(*keys).select(
        clock.bucket_label(F.col("bucket_day"), hour).alias("timestamps"),
        "values",
        F.lit(metric).alias("metric_name"),
        F.lit(labels.metric_unit(metric)).alias("unit"),
        F.lit(interval).alias("interval"),
    )


def time_series(
    trips: DataFrame,
    metric: str = "trip_count",
    interval: str = "hour",
    start=None,
    end=None,
    hours_back: int | None = None,
    week_start: str = "monday",
    as_of=None,
) -> DataFrame:
    """Trip count, revenue or mean fare per hour, day or week, oldest first."""
    params.one_of("metric", metric, params.METRICS)
    params.one_of("interval", interval, params.INTERVALS)
    params.one_of("week_start", week_start, clock.WEEK_STARTS)
    kept = filters.window(trips, start, end, hours_back, as_of)
    keys = clock.bucket_keys(F.col(filters.PICKUP), interval, week_start)
    value = {
        "trip_count": F.count("*"),
        "revenue": measures.exact_sum(F.col("total_amount")),
        "avg_fare": measures.exact_mean(F.col("fare_amount")),
    }[metric]
    return _points(kept.groupBy(*[k.alias(n) for n, k in keys.items()]), value, metric, interval)


def time_series_from_gold(
    hourly_gold: DataFrame,
    metric: str = "trip_count",
    interval: str = "hour",
    start=None,
    end=None,
    week_start: str = "monday",
) -> DataFrame:
    """The same from the hourly gold table, with the mean fare weighted by trips."""
    params.one_of("metric", metric, params.METRICS)
    params.one_of("interval", interval, params.INTERVALS)
    params.one_of("week_start", week_start, clock.WEEK_STARTS)
    kept = hourly_gold.filter(filters.days("metric_date", start, end))
    keys = {"bucket_day": clock.bucket_day(F.col("metric_date"), interval, week_start)}
    if interval == "hour":
        keys["bucket_hour"] = F.col("metric_hour")
    value = {
        "trip_count": F.sum("trip_count"),
        "revenue": measures.exact_sum(F.col("total_revenue")),
        "avg_fare": measures.ratio(measures.exact_sum(F.col("fare_sum")), F.sum("fare_count")),
    }[metric]
    return _points(kept.groupBy(*[k.alias(n) for n, k in keys.items()]), value, metric, interval)
