"""Names shown to the reader of a report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zone_label(zone_id: Column, name: Column) -> Column:
    """The zone's name, or ``Zone <id>`` where it has none."""
    return F.when(name.isNull() | (name == ""), F.concat(F.lit("Zone "), zone_id.cast("string"))).otherwise(name)


def borough_label(name: Column) -> Column:
    return F.when(name.isNull() | (name == ""), F.lit("Unknown")).otherwise(name)


#: The bucket of an hour without a weather row.
NO_WEATHER = "No Weather Data"


def weather_condition(time: Column, precipitation: Column, temperature: Column) -> Column:
    """Weather bucket of an hour; the first rule that holds wins."""
    # The thresholds and labels.
    return (
        F.when(time.isNull(), NO_WEATHER)
        .when(precipitation > 5, "Rainy")
        .when(precipitation > 0, "Light Rain")
        .when(temperature < 0, "Cold")
        .when(temperature > 30, "Hot")
        .otherwise("Clear")
    )


def peak_hour(hour: Column) -> Column:
    """Morning and evening rush, both ends included."""
    # The hours.
    return F.coalesce(hour.between(7, 9) | hour.between(17, 19), F.lit(False))


def metric_unit(metric: str) -> str:
    return "USD" if metric in ("revenue", "avg_fare") else "Trips"
