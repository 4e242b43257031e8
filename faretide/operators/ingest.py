"""Bulk loading of monthly trip files and of weather archive responses."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide import schemas
from faretide.functions import clock

# Array names of an hourly archive response, and the columns they become.
HOURLY_ARRAYS = {
    "time": "time",
    "temperature_2m": "temperature",
    "precipitation": "precipitation",
    "relative_humidity_2m": "humidity",
    "windspeed_10m": "windspeed",
}


def file_profile(spark: SparkSession, paths: str | Sequence[str], column: str = "tpep_pickup_datetime") -> DataFrame:
    """First day, last day and number of rows of every parquet file; files without a day are left out."""
    files = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    day = F.to_date(F.col(column))
    profile = files.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date"), F.count("*").alias("total_rows")
    )
    named = profile.withColumn("file_name", F.element_at(F.split("file_path", "/"), -1))
    return named.filter(F.col("start_date").isNotNull())


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and name of every parquet file, from the directory listing alone.

    The name is the path below the folder asked for (up to its first wildcard), so files of one name in different
    folders stay apart, in this run and in later ones.
    """
    asked = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.option("recursiveFileLookup", True).parquet(*asked).inputFiles()
    roots = sorted((_root(spark, path) for path in asked), key=len, reverse=True)
    rows = []
    for path in found:
        plain = _plain(spark, path)
        root = next((r for r in roots if plain.startswith(r)), plain.rpartition("/")[0] + "/")
        rows.append((path, plain[len(root) :]))
    return spark.createDataFrame(rows, "file_path string, file_name string")


def _plain(spark: SparkSession, path: str) -> str:
    """The path without scheme and host."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def _root(spark: SparkSession, asked: str) -> str:
    """The folder that a path or pattern starts from, with a slash behind it."""
    fixed = re.split(r"[*?\[{]", asked, maxsplit=1)[0]
    if fixed != asked or fixed.endswith(".parquet"):
        fixed = fixed.rpartition("/")[0]
    return _plain(spark, fixed).rstrip("/") + "/"


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not list."""
    return files.join(ledger.select("file_name"), "file_name", "left_anti").select(*files.columns)


def normalize_columns(df: DataFrame, *others: Column) -> DataFrame:
    """Columns of a trip file under their stored names and types; NULL for those it lacks. ``others`` are kept as they are."""
    present = {}
    for name in df.columns:
        present.setdefault(name.lower(), name)
    columns = []
    for f in schemas.TRIP.fields:
        if f.name not in present:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{present[f.name]}`")
        kind = df.schema[present[f.name]].dataType
        if isinstance(f.dataType, T.IntegerType) and not isinstance(kind, T.IntegralType):
            value = value.try_cast("decimal(38,6)")
        columns.append((value if kind == f.dataType else value.try_cast(f.dataType)).alias(f.name))
    return df.select(*columns, *others)


def hourly_arrays_to_rows(responses: DataFrame, column: str = "hourly") -> DataFrame:
    """Parallel arrays of a response to one weather row per position."""
    zipped = F.arrays_zip(*[F.col(f"{column}.{name}").alias(name) for name in HOURLY_ARRAYS])
    rows = responses.select(F.inline(zipped))
    return rows.select(
        *[
            F.col(name).try_cast(schemas.WEATHER[stored].dataType).alias(stored)
            for name, stored in HOURLY_ARRAYS.items()
        ]
    )


def coverage_gaps(ranges: DataFrame, weather: DataFrame, as_of=None) -> DataFrame:
    """Parts of the files' day ranges the weather table does not cover, up to the day before ``as_of``.

    A range that sticks out at both ends gives two rows.
    """
    span = weather.agg(F.struct(F.min(F.to_date("time")).alias("low"), F.max(F.to_date("time")).alias("high")))
    yesterday = F.date_sub(F.to_date(clock.moment(as_of)), 1)
    bounded = ranges.select(
        F.col("file_name").alias("parquet_file"),
        F.col("start_date").alias("first"),
        F.least("end_date", yesterday).alias("last"),
        span.scalar().alias("covered"),
    )
    low, high = F.col("covered.low"), F.col("covered.high")
    before = F.when(
        F.col("first") < low,
        F.struct(F.col("first").alias("start"), F.least(F.date_sub(low, 1), "last").alias("end")),
    )
    after = F.when(
        F.col("last") > high,
        F.struct(F.greatest(F.date_add(high, 1), "first").alias("start"), F.col("last").alias("end")),
    )
    whole = F.struct(F.col("first").alias("start"), F.col("last").alias("end"))
    gaps = F.when(low.isNull(), F.array(whole)).otherwise(F.array_compact(F.array(before, after)))
    found = bounded.select("parquet_file", F.inline(gaps))
    return found.filter(F.col("start") <= F.col("end"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names and types of each file's columns, from its footer alone; NULL where the store can only be read by Spark."""
    for batch in batches:
        told = []
        for path in batch.column("file_path").to_pylist():
            try:
                filesystem, place = pa.fs.FileSystem.from_uri(path)
                found = pq.read_schema(place, filesystem=filesystem)
                told.append(";".join(sorted(f"{f.name}:{f.type}" for f in found)))
            except (pa.ArrowException, OSError, ValueError):
                told.append(None)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.string())], names=[*batch.schema.names, "columns"])


def _placed(path: str) -> Column:
    """A path without its scheme, whether that is written with one slash or three."""
    return F.regexp_replace(path, "^[^:/]+:/+", "/")


def column_groups(files: DataFrame) -> list[list[tuple[str, str]]]:
    """Files (path, name) by the names and types of their columns, which changed over the years.

    All footers are read in one pass over the cluster. Files whose store the workers cannot open are told apart by Spark,
    one after the other.
    """
    schema = T.StructType([*files.schema.fields, T.StructField("columns", T.StringType())])
    rows = files.repartition(FOOTER_TASKS).mapInArrow(_footers, schema).collect()  # names of files, never rows
    groups: dict[str, list[tuple[str, str]]] = {}
    for r in sorted(rows, key=lambda r: r["file_name"]):
        told = r["columns"]
        if told is None:
            told = ";".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in files.sparkSession.read.parquet(r["file_path"]).schema))
        groups.setdefault(told, []).append((r["file_path"], r["file_name"]))
    return list(groups.values())


def load_files(spark: SparkSession, glob: str, lake) -> list[str]:
    """Append the trip files the ledger does not list to ``yellow_taxi_trips``, then list them.

    Only file names pass through the driver. Files with the same columns are one scan, one write and one entry in the
    ledger, however many they are. The table is split by file, and a file's directory is replaced as a whole, so a load
    that died before the ledger was written leaves no doubles when it is repeated.
    """
    files = unprocessed(list_files(spark, glob), lake.read(LEDGER_TABLE))
    done = []
    for group in column_groups(files):
        names = spark.createDataFrame(group, "path string, source_file string").withColumn("_path", _placed("path"))
        rows = spark.read.parquet(*[path for path, _ in group])
        rows = normalize_columns(rows, _placed("_metadata.file_path").alias("_path"))
        named = rows.join(names.drop("path"), "_path", "left")
        unknown = F.raise_error(F.concat(F.lit("rows of a file that was not listed: "), "_path"))
        named = named.withColumn("source_file", F.coalesce("source_file", unknown.cast("string")))
        lake.replace_partitions(named.drop("_path"), TRIP_FILES_TABLE)
        entries = names.select(F.col("source_file").alias("file_name"), F.current_timestamp().alias("ingested_at"))
        lake.append(entries, LEDGER_TABLE)
        done += [name for _, name in group]
    return sorted(done)


def run(spark: SparkSession, glob: str, lake, weather: schemas.TableSpec, fetch: Callable[[DataFrame], DataFrame], as_of=None) -> list[str]:
    """An ingest in order: the files' days, the weather that is missing for them, then the files themselves.

    ``fetch`` gets the gaps (parquet_file, start, end) and gives archive responses with a column ``hourly``. Hours that are
    stored already are replaced. Gives the names of the files loaded.
    """
    gaps = coverage_gaps(file_profile(spark, glob), lake.read(weather), as_of)
    hours = hourly_arrays_to_rows(fetch(gaps)).filter(F.col("time").isNotNull())
    for name in weather.partitions:
        if name not in hours.columns:
            hours = hours.withColumn(name, clock.month_key(F.col("time")) if name == "row_month" else F.to_date("time"))
    lake.merge(weather, hours, ["time"])
    return load_files(spark, glob, lake)


#: Tasks that read footers.
FOOTER_TASKS = 16
LEDGER_TABLE = schemas.TableSpec("ingestion_log", schemas.LEDGER)
TRIP_FILES_TABLE = schemas.TableSpec(
    "yellow_taxi_trips",
    schemas.plus(schemas.TRIP, schemas.struct(source_file=schemas.STRING)),
    partitions=("source_file",),
)
