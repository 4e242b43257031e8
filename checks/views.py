"""Trips, zones, weather and change records formed from the test tables.

Every view comes twice: as a DataFrame, and as SQL for the comparison (``CTES``). The column
expressions are inputs, not results, so the two share them; only functions the engines spell
differently are filled in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30 12:00:00"

SPARK = {
    "seconds": "make_dt_interval(0, 0, 0, {})",
    "hours": "make_dt_interval(0, CAST({} AS INT))",
    "k": "get_json_object(props, '$.k')",
}
DUCKDB = {"seconds": "to_seconds({})", "hours": "to_hours({})", "k": "json_extract_string(props, '$.k')"}

TRIP_COLUMNS = {
    "vendorid": "CAST(user_id % 2 + 1 AS INT)",
    "tpep_pickup_datetime": "ts",
    "tpep_dropoff_datetime": "ts + <seconds:300 + (event_id * 37) % 3300>",
    "passenger_count": "CAST(event_id % 6 + 1 AS INT)",
    "trip_distance": "CAST(event_id % 300 AS DOUBLE) / 10",
    "ratecodeid": "CAST(event_id % 6 + 1 AS INT)",
    "store_and_fwd_flag": "CASE WHEN event_id % 11 = 0 THEN 'Y' ELSE 'N' END",
    "pulocationid": "CAST((user_id * 7) % 30 AS INT)",
    "dolocationid": "CAST(<k> AS INT) % 30",
    "payment_type": "CAST(event_id % 5 + 1 AS INT)",
    "fare_amount": "value",
    "extra": "CAST(event_id % 4 AS DOUBLE) / 2",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "CAST(event_id % 20 AS DOUBLE) / 4",
    "tolls_amount": "CAST(event_id % 3 AS DOUBLE)",
    "improvement_surcharge": "CAST(event_id % 2 AS DOUBLE)",
    "total_amount": "value + CAST(event_id % 20 AS DOUBLE) / 4 + CAST(event_id % 3 AS DOUBLE)",
    "congestion_surcharge": "CASE WHEN event_id % 3 = 0 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "airport_fee": "CASE WHEN event_id % 7 = 0 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "cbd_congestion_fee": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(0.75 AS DOUBLE) END",
}

BENCH_COLUMNS = {
    "vendorid": "l_linenumber",
    "tpep_pickup_datetime": "l_shipdate + <hours:l_orderkey % 24>",
    "tpep_dropoff_datetime": "l_shipdate + <hours:l_orderkey % 24 + 1>",
    "passenger_count": "l_linenumber",
    "trip_distance": "l_quantity",
    "pulocationid": "CAST((l_suppkey * 7) % 30 AS INT)",
    "dolocationid": "CAST(l_partkey % 30 AS INT)",
    "fare_amount": "l_extendedprice",
    "tip_amount": "l_discount",
    "tolls_amount": "l_tax",
    "total_amount": "l_extendedprice + l_quantity",
}

ZONE_COLUMNS = {
    "LocationID": "n_nationkey",
    "Borough": "r_name",
    "Zone": "n_name",
    "service_zone": "CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END",
}

WEATHER_COLUMNS = {
    "time": "h",
    "temperature": "CAST((n * 7) % 45 - 8 AS DOUBLE)",
    "precipitation": "CASE WHEN n % 5 = 0 THEN CAST(n % 13 AS DOUBLE) / 2 ELSE CAST(0 AS DOUBLE) END",
    "humidity": "CAST((n * 11) % 60 + 35 AS DOUBLE)",
    "windspeed": "CAST(n % 20 AS DOUBLE)",
}

# What the change records do to a trip, by event_id: operation, condition, offset of its commit
# time, and the values it sets. Fares are negative in some rows and vendors missing in others.
BAD_FARE, NO_VENDOR = "event_id % 17 = 0", "event_id % 23 = 0"
VERSIONS = (
    ("c", "TRUE", 0, {}),
    ("u", "event_id % 10 = 0", 1, {"fare_amount": "fare_amount + 1", "total_amount": "total_amount + 1"}),
    ("u", "event_id % 10 = 2", 1, {"tpep_dropoff_datetime": "tpep_dropoff_datetime + <seconds:60>"}),
    ("d", "event_id % 10 = 1", 2, {}),
    ("c", "event_id % 20 = 1", 3, {"fare_amount": "fare_amount + 2", "total_amount": "total_amount + 2"}),
)


def fill(text: str, dialect: dict[str, str]) -> str:
    """Replace ``<name>`` and ``<name:argument>`` by the dialect's spelling."""
    for name, spelling in dialect.items():
        text = text.replace(f"<{name}>", spelling)
        while f"<{name}:" in text:
            head, _, rest = text.partition(f"<{name}:")
            argument, _, tail = rest.partition(">")
            text = head + spelling.format(argument) + tail
    return text


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{fill(e, SPARK)} AS {n}" for n, e in columns.items()]


# Column types of the test tables read here; naming them saves a job per read that infers them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{d}/{name}.parquet")


def trips(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(*_select(TRIP_COLUMNS), *extra)


def bench_trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(*_select(BENCH_COLUMNS))


def zones(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(*_select(ZONE_COLUMNS))


def all_hours(spark: SparkSession, d: str) -> DataFrame:
    """Every hour with events and its number since 2024-01-01."""
    hours = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).distinct()
    number = F.datediff("day", F.lit("2024-01-01").cast("date")) * 24 + F.col("hour")
    return hours.select(
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour"))).alias("h"),
        number.cast("bigint").alias("n"),
    )


def weather(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    """Hourly weather that lacks every sixth hour."""
    return all_hours(spark, d).filter("n % 6 <> 0").selectExpr(*_select(WEATHER_COLUMNS), *extra)


def micros(ts: Column) -> Column:
    """Wall-clock time as epoch microseconds, as a connector sends a timestamp without zone."""
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000_000 + second


TLC_SPELLING = {
    "vendorid": "VendorID",
    "ratecodeid": "RatecodeID",
    "pulocationid": "PULocationID",
    "dolocationid": "DOLocationID",
    "airport_fee": "Airport_fee",
}


def payload(columns: dict[str, Column]) -> Column:
    """A row as the JSON object a connector sends."""
    times = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "time")
    return F.to_json(F.struct(*[(micros(c) if n in times else c).alias(n) for n, c in columns.items()]))


def envelope(op: Column, ts_ms: Column, before: Column, after: Column) -> Column:
    null = F.lit("null")
    return F.concat(
        F.lit('{"op":"'), op, F.lit('","ts_ms":'), ts_ms.cast("string"),
        F.lit(',"before":'), F.coalesce(before, null),
        F.lit(',"after":'), F.coalesce(after, null), F.lit("}"),
    )


def _other_spelling(text: Column) -> Column:
    for name, tlc in TLC_SPELLING.items():
        text = F.replace(text, F.lit(f'"{name}"'), F.lit(f'"{tlc}"'))
    return text


def trip_changes(spark: SparkSession, d: str, parts: int = 1, part: int = 0) -> DataFrame:
    """Change records of the trips (``VERSIONS``), in both spellings, with some junk among them.

    With ``parts``, one of so many parts, dealt by trip and version; only its own records are formed, spread over all cores.
    """
    rows = trips(spark, d, "event_id").withColumns(
        {
            "fare_amount": F.when(F.expr(BAD_FARE), -F.col("fare_amount")).otherwise(F.col("fare_amount")),
            "vendorid": F.when(~F.expr(NO_VENDOR), F.col("vendorid")),
        }
    )
    numbers = F.array(*[F.when(F.expr(v[1]), F.lit(i)) for i, v in enumerate(VERSIONS)])
    rows = rows.withColumn("version", F.explode(F.array_compact(numbers)))
    if parts > 1:
        own = ("event_id", "tpep_pickup_datetime", "version")
        # A text takes far longer to form than its row to send, and a small file is few tasks.
        rows = rows.filter(F.pmod(F.xxhash64(*own), F.lit(parts)) == part).repartition(*own)
    old = {n: F.col(n) for n in TRIP_COLUMNS}
    new = dict(old)
    op, delay = F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, (code, _, after_ms, changed) in enumerate(VERSIONS):
        here = F.col("version") == i
        op, delay = F.when(here, code).otherwise(op), F.when(here, after_ms).otherwise(delay)
        for name, value in changed.items():
            new[name] = F.when(here, F.expr(fill(value, SPARK))).otherwise(new[name])
    sides = rows.select(
        "event_id",
        "version",
        op.alias("op"),
        (F.col("event_id") * 10 + delay).alias("ts_ms"),
        payload(old).alias("old"),
        payload(new).alias("new"),
    )
    before = F.when(F.col("op").isin("u", "d"), F.col("old"))
    after = F.when(F.col("op").isin("c", "u"), F.col("new"))
    record = envelope(F.col("op"), F.col("ts_ms"), before, after)
    record = F.when(F.col("event_id") % 2 == 0, record).otherwise(_other_spelling(record))
    junk = F.array(F.lit('{"op":"t","after":null}'), F.lit('{"op":"c","after":{"vendorid":'))
    first = (F.col("version") == 0) & (F.col("event_id") % 50 == 3)
    records = F.when(first, F.array_append(junk, record)).otherwise(F.array(record))
    return sides.select(F.explode(records).alias("value"))


def trip_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Every trip as a record of the initial snapshot."""
    row = payload({n: F.col(n) for n in TRIP_COLUMNS})
    null = F.lit(None).cast("string")
    return trips(spark, d).select(envelope(F.lit("r"), F.lit(0), null, row).alias("value"))


def weather_changes(spark: SparkSession, d: str) -> DataFrame:
    """Change records of the weather: all created, some corrected, some deleted, some worthless."""
    rows = weather(spark, d, "n").withColumn(
        "temperature", F.when(F.expr("n % 25 = 1"), F.lit(-101.0)).otherwise(F.col("temperature"))
    )
    old = payload({n: F.col(n) for n in WEATHER_COLUMNS})
    new = payload({**{n: F.col(n) for n in WEATHER_COLUMNS}, "temperature": F.col("temperature") + 1})
    key, null, ts_ms = payload({"time": F.col("time")}), F.lit(None).cast("string"), F.col("n") * 10
    records = F.array(
        envelope(F.lit("c"), ts_ms, null, old),
        F.when(F.expr("n % 4 = 1"), envelope(F.lit("u"), ts_ms + 1, old, new)),
        F.when(F.expr("n % 9 = 2"), envelope(F.lit("d"), ts_ms + 2, key, null)),
        F.when(F.expr("n % 7 = 3"), envelope(F.lit("u"), ts_ms + 3, null, null)),
    )
    return rows.select(F.explode(F.array_compact(records)).alias("value"))


# -- the same for DuckDB -----------------------------------------------------------------------


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f'{fill(e, DUCKDB)} AS "{n}"' for n, e in columns.items())


def _version(op: str, condition: str, delay: int, changed: dict[str, str]) -> str:
    values = ", ".join(f"{fill(changed.get(n, n), DUCKDB)} AS {n}" for n in TRIP_COLUMNS)
    return f"SELECT event_id, '{op}' AS op, event_id * 10 + {delay} AS ts_ms, {values} FROM bad_trips WHERE {condition}"


FLOATS = (
    "trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount "
    "congestion_surcharge airport_fee cbd_congestion_fee"
).split()

CTES = {
    "trips": f"SELECT {_list(TRIP_COLUMNS)}, event_id FROM events",
    "bad_trips": f"""SELECT * REPLACE (
        CASE WHEN {BAD_FARE} THEN -fare_amount ELSE fare_amount END AS fare_amount,
        CASE WHEN {NO_VENDOR} THEN NULL ELSE vendorid END AS vendorid) FROM trips""",
    "versions": " UNION ALL ".join(_version(*v) for v in VERSIONS),
    # Versions as decoded: measures in single precision.
    "decoded": "SELECT * REPLACE ("
    + ", ".join(f"CAST({n} AS FLOAT) AS {n}" for n in FLOATS)
    + ") FROM versions",
    "zones": f"SELECT {_list(ZONE_COLUMNS)} FROM nation JOIN region ON n_regionkey = r_regionkey",
    "all_hours": """SELECT h, date_diff('day', DATE '2024-01-01', CAST(h AS DATE)) * 24 + hour(h) AS n
        FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)""",
    "weather": f"SELECT {_list(WEATHER_COLUMNS)}, n FROM all_hours WHERE n % 6 <> 0",
    "bad_weather": """SELECT * REPLACE (CASE WHEN n % 25 = 1 THEN -101 ELSE temperature END AS temperature)
        FROM weather""",
    "bench_trips": f"SELECT {_list(BENCH_COLUMNS)} FROM lineitem",
}


def sql(body: str) -> str:
    """``body`` with the views in front of it."""
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in CTES.items()) + "\n" + body.strip()


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({money(x)} / COUNT({x}))"


def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"
