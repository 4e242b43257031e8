"""Row types, stored tables and change-stream descriptions.

The column lists, key columns and spellings below are fixed values: they are the interface of the
source tables and of the stored tables, and results only line up when they are the same.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

INT, LONG, FLOAT, DOUBLE = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
STRING, BOOLEAN, DATE, TIME = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampNTZType()
INSTANT = T.TimestampType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TRIP = struct(
    vendorid=INT,
    tpep_pickup_datetime=TIME,
    tpep_dropoff_datetime=TIME,
    passenger_count=INT,
    trip_distance=FLOAT,
    ratecodeid=INT,
    store_and_fwd_flag=STRING,
    pulocationid=INT,
    dolocationid=INT,
    payment_type=INT,
    fare_amount=FLOAT,
    extra=FLOAT,
    mta_tax=FLOAT,
    tip_amount=FLOAT,
    tolls_amount=FLOAT,
    improvement_surcharge=FLOAT,
    total_amount=FLOAT,
    congestion_surcharge=FLOAT,
    airport_fee=FLOAT,
    cbd_congestion_fee=FLOAT,
)

WEATHER = struct(time=TIME, temperature=FLOAT, precipitation=FLOAT, humidity=FLOAT, windspeed=FLOAT)

ZONE = struct(LocationID=INT, Borough=STRING, Zone=STRING, service_zone=STRING)

LEDGER = struct(file_name=STRING, ingested_at=INSTANT)

# Spellings under which a column may also arrive.
TRIP_SPELLINGS = {
    "vendorid": ("VendorID",),
    "ratecodeid": ("RatecodeID",),
    "pulocationid": ("PULocationID",),
    "dolocationid": ("DOLocationID",),
    "airport_fee": ("Airport_fee",),
}

TRIP_KEY = ("vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime")
LIVE_TRIP_KEY = ("tpep_pickup_datetime", "pulocationid", "vendorid")
WEATHER_KEY = ("time",)
ZONE_KEY = ("LocationID",)


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its columns, and which of them split it into directories.

    ``only`` makes it a view of the directories with that last name, e.g. ``_kind=live``.
    """

    name: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    only: str | None = None


PARTITION_COLUMNS = {
    "day": T.StructField("row_date", DATE),
    "month": T.StructField("row_month", STRING),
    "all": T.StructField("row_group", STRING),
}


@dataclass(frozen=True)
class ChangeSpec:
    """How the change records of one source table are decoded, checked and merged."""

    name: str
    payload: T.StructType
    key: tuple[str, ...]
    rules: str | None = None
    spellings: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    drop_null_payload: bool = False
    zero_defaults: bool = False
    apply_deletes: bool = True
    # Stored rows are split by the day or the month of ``partition_source``, or not at all.
    partition_source: str | None = None
    partition_unit: str = "all"

    @property
    def partition(self) -> str:
        return PARTITION_COLUMNS[self.partition_unit].name


TRIP_CHANGES = ChangeSpec(
    name="trips",
    payload=TRIP,
    key=TRIP_KEY,
    rules="trips",
    spellings=TRIP_SPELLINGS,
    partition_source="tpep_pickup_datetime",
    partition_unit="day",
)

WEATHER_CHANGES = ChangeSpec(
    name="weather",
    payload=WEATHER,
    key=WEATHER_KEY,
    rules="weather",
    drop_null_payload=True,
    partition_source="time",
    partition_unit="month",
)

# Real-time tables: no quality rules, zero defaults, deletes are not applied.
LIVE_TRIP_CHANGES = ChangeSpec(
    name="live_trips",
    payload=TRIP,
    key=LIVE_TRIP_KEY,
    spellings=TRIP_SPELLINGS,
    zero_defaults=True,
    apply_deletes=False,
    partition_source="tpep_pickup_datetime",
    partition_unit="month",
)

LIVE_WEATHER_CHANGES = ChangeSpec(
    name="live_weather",
    payload=WEATHER,
    key=WEATHER_KEY,
    zero_defaults=True,
    apply_deletes=False,
    partition_source="time",
    partition_unit="month",
)

LIVE_ZONE_CHANGES = ChangeSpec(
    name="live_zones", payload=ZONE, key=ZONE_KEY, zero_defaults=True, apply_deletes=False
)

# Sums kept beside the averages of a gold row, so that coarser averages can be formed exactly.
GOLD_SUMS = struct(fare_sum=DOUBLE, fare_count=LONG, distance_sum=DOUBLE, distance_count=LONG)
# Of the hourly rows also: what it takes to add changes to every figure of a stored row.
GOLD_HOURLY_SUMS = struct(
    revenue_count=LONG, passenger_sum=DOUBLE, passenger_values=LONG, tip_count=LONG, tolls_count=LONG
)


def plus(*parts: T.StructType) -> T.StructType:
    return T.StructType([column for part in parts for column in part.fields])


GOLD_HOURLY = TableSpec(
    "gold_hourly_metrics",
    plus(
        struct(
            metric_date=DATE,
            metric_hour=INT,
            pulocationid=INT,
            dolocationid=INT,
            borough=STRING,
            trip_count=LONG,
            total_revenue=DOUBLE,
            avg_fare=DOUBLE,
            avg_distance=DOUBLE,
            avg_passengers=DOUBLE,
            tip_sum=DOUBLE,
            tolls_sum=DOUBLE,
            peak_hour=BOOLEAN,
            processed_time=INSTANT,
        ),
        GOLD_SUMS,
        GOLD_HOURLY_SUMS,
    ),
    partitions=("metric_date",),
    sort_by=("metric_hour", "pulocationid"),
)

# Not a report: what the zone and borough tables are formed from.
GOLD_ZONE_DAILY = TableSpec(
    "gold_zone_daily",
    plus(
        struct(
            metric_date=DATE,
            zone_id=INT,
            is_pickup=BOOLEAN,
            trip_count=LONG,
            total_revenue=DOUBLE,
        ),
        GOLD_SUMS,
        struct(dropoff_count=LONG),
    ),
    partitions=("metric_date",),
)

GOLD_ZONE = TableSpec(
    "gold_zone_performance",
    plus(
        struct(
            zone_id=INT,
            zone_name=STRING,
            borough=STRING,
            total_trips=LONG,
            total_revenue=DOUBLE,
            avg_fare=DOUBLE,
            avg_distance=DOUBLE,
            pickup_count=LONG,
            dropoff_count=LONG,
            last_updated=INSTANT,
        ),
        GOLD_SUMS,
    ),
    partitions=("borough",),
)

GOLD_BOROUGH = TableSpec(
    "gold_borough_summary",
    plus(
        struct(
            borough=STRING,
            metric_date=DATE,
            total_trips=LONG,
            total_revenue=DOUBLE,
            avg_fare=DOUBLE,
            avg_distance=DOUBLE,
            trip_count_pickup=LONG,
            trip_count_dropoff=LONG,
            last_updated=INSTANT,
        ),
        GOLD_SUMS,
    ),
    partitions=("metric_date",),
)
