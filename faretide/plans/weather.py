"""Trips by weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.functions import clock, labels, measures
from faretide.operators import filters, params


def weather_impact(
    trips: DataFrame,
    weather: DataFrame | None,
    start=None,
    end=None,
    hours_back: int = 720,
    limit: int | None = None,
    as_of=None,
) -> DataFrame:
    """Trips, mean fare and mean distance per hour with that hour's weather, newest first.

    ``hours_back`` counts only where no date is given; all hours are shown unless ``limit`` says how many. Trips are reduced to hours before the join,
    so what is joined has one row per hour on both sides. Without a weather table the conditions
    are unknown and fixed values stand in for them.
    """
    params.between("hours_back", hours_back, params.WEATHER_HOURS)
    dated = start not in (None, "") or end not in (None, "")
    back = None if dated else hours_back
    kept = filters.window(trips, start, end, back, as_of)
    hourly = kept.groupBy(F.to_date(filters.PICKUP).alias("date"), F.hour(filters.PICKUP).alias("clock_hour")).agg(
        F.count("*").alias("trips"),
        measures.rounded(measures.exact_mean(F.col("fare_amount")), 2).alias("avg_fare"),
        measures.rounded(measures.exact_mean(F.col("trip_distance"), measures.DISTANCE), 2).alias("avg_distance"),
    )
    if weather is None:
        joined = hourly.withColumns(
            {
                "weather_condition": F.lit("Unknown"),
                "temperature": F.lit(20.0),
                "humidity": F.lit(50.0),
            }
        )
    else:
        hours = filters.hourly_weather(filters.weather_window(weather, start, end, back, as_of)).select(
            F.col("weather_day").alias("date"),
            F.col("weather_hour").alias("clock_hour"),
            F.col("time").alias("w_time"),
            F.col("temperature").alias("w_temperature"),
            F.col("humidity").alias("w_humidity"),
            F.col("precipitation").alias("w_precipitation"),
        )
        joined = hourly.join(hours, ["date", "clock_hour"], "left").withColumns(
            {
                "weather_condition": labels.weather_condition(
                    F.col("w_time"), F.col("w_precipitation"), F.col("w_temperature")
                ),
                "temperature": measures.rounded(measures.finite(F.col("w_temperature")), 1),
                "humidity": measures.rounded(measures.finite(F.col("w_humidity")), 1),
            }
        )
    report = joined.orderBy(F.desc("date"), F.desc("clock_hour")).select(
        "date",
        clock.hour_label(F.col("clock_hour")).alias("hour"),
        "weather_condition",
        "temperature",
        "humidity",
        "trips",
        "avg_fare",
        "avg_distance",
    )
    return report if limit is None else report.limit(limit)


def in_time_order(impact: DataFrame) -> DataFrame:
    """The hourly report from the oldest hour on, by the time that its day and hour label make up (``time``)."""
    time = F.to_timestamp_ntz(F.concat_ws(" ", F.col("date").cast("string"), "hour"), F.lit("yyyy-MM-dd HH:mm"))
    return impact.withColumn("time", time).orderBy("time")


def weather_condition_rollup(impact: DataFrame) -> DataFrame:
    """Trips and mean fare per weather condition, from the hourly report.

    ``avg_fare`` is the mean over hours; ``weighted_avg_fare`` weighs each hour by its trips.
    """
    cost = F.rint(F.col("avg_fare") * 100).cast("bigint")
    return (
        impact.groupBy("weather_condition")
        .agg(
            F.sum("trips").alias("trips"),
            measures.exact_mean(F.col("avg_fare")).alias("avg_fare"),
            measures.ratio(
                F.sum(cost * F.col("trips")) / F.lit(100.0),
                F.sum(F.when(F.col("avg_fare").isNotNull(), F.col("trips"))),
            ).alias("weighted_avg_fare"),
        )
        .orderBy(F.desc("trips"), "weather_condition")
    )
