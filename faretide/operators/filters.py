"""Row filters of the reports, with constants on one side so that they reach the parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.functions import clock, labels
from faretide.operators import merge

PICKUP = "tpep_pickup_datetime"

Day = date | datetime | str | None


def has_time(value: Day) -> bool:
    if isinstance(value, str):
        return " " in value.strip() or "T" in value
    return isinstance(value, datetime)


def as_day(value: Day) -> date | None:
    """The calendar day of a bound given as text, date or datetime."""
    if value is None or value == "":
        return None
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    return value.date() if isinstance(value, datetime) else value


def date_range(column: str, start: Day = None, end: Day = None) -> Column:
    """``start <= column``, and up to the last moment of the day ``end``.

    A bound with a time of day is taken as it is, both ends included.
    """
    value, kept = F.col(column), F.lit(True)
    if start not in (None, ""):
        kept = kept & (value >= clock.moment(str(start)))
    if end not in (None, ""):
        if has_time(end):
            kept = kept & (value <= clock.moment(str(end)))
        else:
            kept = kept & (value < clock.moment(str(as_day(end) + timedelta(days=1))))
    return kept


def last_hours(column: str, hours: int, as_of=None) -> Column:
    return F.col(column) >= clock.back(clock.moment(as_of), hours=hours)


def window(
    df: DataFrame,
    start: Day = None,
    end: Day = None,
    hours_back: int | None = None,
    as_of=None,
    column: str = PICKUP,
) -> DataFrame:
    """Rows of a date range, or of the last hours; ``hours_back`` overrides the dates.

    A table stored by ``row_date`` or ``row_month`` gets the same bounds on that column, which prunes directories.
    """
    if hours_back:
        first = clock.back(clock.moment(as_of), hours=hours_back)
        return prune(df.filter(last_hours(column, hours_back, as_of)), column, F.to_date(first), None)
    if start in (None, "") and end in (None, ""):
        return df
    bounds = [F.lit(as_day(x)) if as_day(x) else None for x in (start, end)]
    return prune(df.filter(date_range(column, start, end)), column, *bounds)


#: Event times by which stored tables are split.
SPLIT_TIMES = (PICKUP, "time")


def prune(df: DataFrame, column: str, first: Column | None, last: Column | None) -> DataFrame:
    """Day bounds of an event time as bounds on the partition column of its table, if it has one."""
    if column not in SPLIT_TIMES:
        return df
    for partition, key in (("row_date", lambda day: day), ("row_month", clock.month_key)):
        if partition in df.columns:
            if first is not None:
                df = df.filter(F.col(partition) >= key(first))
            if last is not None:
                df = df.filter(F.col(partition) <= key(last))
    return df


def days(column: str, start: Day = None, end: Day = None) -> Column:
    """Whole-day range on a DATE column, both ends included."""
    kept = F.lit(True)
    if as_day(start):
        kept = kept & (F.col(column) >= F.lit(as_day(start)))
    if as_day(end):
        kept = kept & (F.col(column) <= F.lit(as_day(end)))
    return kept


def clamp_range(start: Day, end: Day, max_days: int) -> tuple[date | None, date | None, bool]:
    """The range, its last ``max_days`` days where it is longer, and whether it was narrowed."""
    first, last = as_day(start), as_day(end)
    if first and last and (last - first).days > max_days:
        return last - timedelta(days=max_days), last, True
    return first, last, False


def weather_window(weather: DataFrame, start: Day = None, end: Day = None, hours_back: int | None = None, as_of=None) -> DataFrame:
    """Weather of all hours that :func:`window` takes trips of, and of an hour before and after, so that no hour is cut."""
    if hours_back:
        return window(weather, hours_back=hours_back + 1, as_of=as_of, column="time")
    first = clock.back(clock.moment(str(start)), hours=1) if start not in (None, "") else None
    last = None
    if end not in (None, ""):
        last = clock.moment(str(end) if has_time(end) else f"{as_day(end)} 23:59:59") + F.expr("INTERVAL 1 HOUR")
    kept = weather if first is None else weather.filter(F.col("time") >= first)
    kept = kept if last is None else kept.filter(F.col("time") <= last)
    return prune(kept, "time", *[None if x is None else F.to_date(x) for x in (first, last)])


def hourly_weather(weather: DataFrame) -> DataFrame:
    """One weather row per hour, the latest one, keyed by ``weather_day`` and ``weather_hour``."""
    keyed = weather.filter(F.col("time").isNotNull()).withColumns(
        {"weather_day": F.to_date("time"), "weather_hour": F.hour("time")}
    )
    versions = [c for c in ("_processing_time",) if c in weather.columns]
    measures = ["temperature", "humidity", "precipitation"]
    return merge.keep_latest(keyed, ["weather_day", "weather_hour"], ["time", *versions, *measures])


def analytics_filter(
    trips: DataFrame,
    zones: DataFrame | None = None,
    weather: DataFrame | None = None,
    start: Day = None,
    end: Day = None,
    zone_ids: Sequence[int] | None = None,
    borough: str | None = None,
    weather_conditions: Sequence[str] | None = None,
    min_fare: float | None = None,
    max_fare: float | None = None,
) -> DataFrame:
    """Trips that meet all the conditions given."""
    kept = window(trips, start, end)
    if zone_ids is not None:
        kept = kept.filter(F.col("pulocationid").isin(*zone_ids))
    if min_fare is not None:
        kept = kept.filter(F.col("fare_amount") >= min_fare)
    if max_fare is not None:
        kept = kept.filter(F.col("fare_amount") <= max_fare)
    if borough is not None:
        inside = zones.filter(F.col("Borough") == borough).select(F.col("LocationID").alias("pulocationid"))
        kept = kept.join(inside, "pulocationid", "left_semi")
    if weather_conditions is not None:
        # Hours are judged before the join, so no trip is joined that does not stay: trips of an hour that is asked
        # for, or, where hours without weather are asked for, all but those of the other hours.
        hours = hourly_weather(weather_window(weather, start, end))
        condition = labels.weather_condition(F.col("time"), F.col("precipitation"), F.col("temperature"))
        wanted, unknown = condition.isin(*weather_conditions), labels.NO_WEATHER in weather_conditions
        hours = hours.filter(~wanted if unknown else wanted).select("weather_day", "weather_hour")
        same_hour = (F.to_date(PICKUP) == F.col("weather_day")) & (F.hour(PICKUP) == F.col("weather_hour"))
        kept = kept.join(hours, same_hour, "left_anti" if unknown else "left_semi")
    return kept.select(*trips.columns)
