"""Wall-clock time. Columns are TIMESTAMP_NTZ and no expression here looks at the session zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# First and last microsecond of the years 1 to 9999, the range of a SQL timestamp.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999

INTERVALS = ("hour", "day", "week")
WEEK_STARTS = ("monday", "sunday")


def wall_clock(micros: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp to TIMESTAMP_NTZ; NULL outside years 1-9999."""
    since_epoch = F.expr("INTERVAL '0.000001' SECOND") * micros
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.expr(EPOCH) + since_epoch)


def moment(value: Column | datetime | date | str | None) -> Column:
    """A reference time ("now" unless given) as TIMESTAMP_NTZ. Constants fold, so filters push down."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def from_text(text: Column) -> Column:
    """A time written as ISO text, with or without time of day or zone; NULL for what is none. A zone is left out."""
    return text.try_cast("timestamp_ntz")


def back(as_of: Column, hours: int = 0, days: int = 0) -> Column:
    return as_of - F.make_dt_interval(F.lit(days), F.lit(hours))


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def bucket_keys(ts: Column, interval: str, week_start: str = "monday") -> dict[str, Column]:
    """Grouping keys of a time bucket: its day, and its hour for hourly buckets."""
    day = F.to_date(ts)
    if interval == "hour":
        return {"bucket_day": day, "bucket_hour": F.hour(ts)}
    return {"bucket_day": bucket_day(day, interval, week_start)}


def bucket_day(day: Column, interval: str, week_start: str = "monday") -> Column:
    """First day of the day or week bucket a date falls into."""
    if interval == "week":
        # weekday(): Monday is 0; dayofweek(): Sunday is 1.
        offset = F.weekday(day) if week_start == "monday" else F.dayofweek(day) - 1
        return F.date_sub(day, offset)
    return day


def bucket_label(day: Column, hour: Column | None = None) -> Column:
    """``2024-01-31T07:00:00Z``"""
    clock = F.lit("00") if hour is None else F.lpad(hour.cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit(":00:00Z"))


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def month_key(ts: Column) -> Column:
    """``yyyyMM`` as a string, the monthly partition key."""
    return (F.year(ts) * 100 + F.month(ts)).cast("string")
