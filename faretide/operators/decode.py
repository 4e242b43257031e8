"""Change envelopes ``{"op", "before", "after", "ts_ms"}`` to typed rows.

A raw frame has a string column ``value`` and may have ``partition``, ``offset`` and ``timestamp`` (position in its source).
Each record is parsed once, into texts: a column is found under any of its spellings (JSON names
are case-sensitive), and a bad number spoils only its own column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide import schemas
from faretide.functions import clock
from faretide.schemas import ChangeSpec

UPSERT_OPS = ("c", "u", "r")  # create, update, snapshot read
DELETE_OP = "d"

# Order of changes to one key: position in the source's log, commit time, then position in the stream, then life cycle.
# An offset only says something within its partition, so the partition comes first. A record without a commit time
# counts from when the source, or else the broker, saw it. Records without any of these can tie; then a delete comes last.
ORDER = ("_lsn", "_ts_ms", "_partition", "_offset", "_rank")

#: Why a record yields no change that can be applied.
NOT_A_CHANGE = "no change record"


def _sides_as(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, schemas.STRING) for name in names])


def _spelled(spec: ChangeSpec, separator: str | None = None) -> list[str]:
    """Every spelling of every column; with ``separator`` as names that differ in more than case."""
    names = []
    for name in spec.payload.names:
        for i, spelling in enumerate((name, *spec.spellings.get(name, ()))):
            names.append(f"{name}{separator}{i}" if separator else spelling)
    return names


def parse(raw: DataFrame, spec: ChangeSpec | None = None, *columns: Column) -> DataFrame:
    """``op``, ``ts_ms``, ``before`` and ``after`` of every record; ``op`` is NULL for what is no envelope.

    A record that is cut off counts as none, whatever could be read of it.
    """
    fields = _sides_as(_spelled(spec) if spec else [])
    origin = schemas.struct(lsn=schemas.STRING, ts_ms=schemas.STRING)
    envelope = schemas.struct(
        op=schemas.STRING, ts_ms=schemas.STRING, source=origin, before=fields, after=fields, broken=schemas.STRING
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = raw.select(F.from_json("value", envelope, options).alias("e"), *columns)
    op = F.when(F.col("e.broken").isNull(), F.col("e.op")).alias("op")
    if not spec:
        return parsed.select(op)
    # Names that differ only in case cannot be told apart in a query: rename them by position.
    distinct = _sides_as(_spelled(spec, "__"))
    sides = [F.col(f"e.{side}").cast(distinct).alias(side) for side in ("before", "after")]
    others = [c for c in parsed.columns if c != "e"]
    return parsed.select(op, F.col("e.ts_ms").alias("ts_ms"), F.col("e.source").alias("source"), *sides, *others)


def operation_counts(raw: DataFrame) -> DataFrame:
    """Records per operation and the side they are routed to."""
    route = (
        F.when(F.col("op").isin(*UPSERT_OPS), "upsert").when(F.col("op") == DELETE_OP, "delete").otherwise("dropped")
    )
    return parse(raw).groupBy("op").agg(F.count("*").alias("records")).withColumn("route", route)


def _text(payload: Column, spec: ChangeSpec, name: str) -> Column:
    spellings = range(1 + len(spec.spellings.get(name, ())))
    texts = [payload.getField(f"{name}__{i}") for i in spellings]
    return F.coalesce(*texts) if len(texts) > 1 else texts[0]


def _typed(text: Column, kind: T.DataType) -> Column:
    """A payload text as its type; NULL for what does not fit. A time stays in microseconds here."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegerType):
        # '3.0' is a valid 3. Every INT is exact as a double.
        return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    if isinstance(kind, T.TimestampNTZType):
        return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))
    return text.try_cast(kind)


def _with_times(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    times = [f.name for f in fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: clock.wall_clock(F.col(name)) for name in times})


def _zero(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(clock.EPOCH)
    return F.lit(0).cast(kind)


def _column(payload: Column, spec: ChangeSpec, field: T.StructField) -> Column:
    return _typed(_text(payload, spec, field.name), field.dataType)


def _position(raw: DataFrame) -> list[Column]:
    """Where in its stream a record stands; NULL for what the source does not tell."""

    def given(name: str, kind: str) -> Column:
        return (F.col(name) if name in raw.columns else F.lit(None)).cast(kind)

    seen = F.unix_millis(given("timestamp", "timestamp"))
    return [given("partition", "int").alias("_partition"), given("offset", "bigint").alias("_offset"), seen.alias("_seen_ms")]


def decode_changes(raw: DataFrame, spec: ChangeSpec, keep_unreadable: bool = False) -> DataFrame:
    """Every change as one row: payload columns, ``_is_delete``, ``_operation`` and the order columns.

    An update that moves a row to another key yields two: a delete of the old key and an upsert of
    the new one. Unknown operations, tombstones and broken records yield none, or with
    ``keep_unreadable`` one row each, which has ``_is_delete`` NULL and the record in ``_record``.
    """
    record = [F.col("value").alias("_record")] if keep_unreadable else []
    parsed = parse(raw, spec, *_position(raw), *record)
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    # Texts as sent: one producer writes a value the same way on both sides.
    old, new = ([_text(side, spec, name) for name in spec.key] for side in (before, after))
    moved = reduce(Column.__and__, [part.isNotNull() for part in old]) & reduce(
        Column.__or__, [~left.eqNullSafe(right) for left, right in zip(old, new)]
    )
    gone = F.struct(F.lit(True).alias("_is_delete"), before.alias("payload"))
    kept = F.struct(F.lit(False).alias("_is_delete"), after.alias("payload"))
    sides = (
        F.when(op == DELETE_OP, F.array(gone))
        .when((op == "u") & moved, F.array(gone, kept))
        .when(op.isin(*UPSERT_OPS), F.array(kept))
    )
    # explode() keeps later filters from pulling a second parse of the record below it.
    each = F.explode_outer if keep_unreadable else F.explode
    extra = ["_record"] if keep_unreadable else []
    rows = parsed.select(each(sides).alias("side"), "op", "ts_ms", "source", "_partition", "_offset", "_seen_ms", *extra)
    payload, is_delete = F.col("side.payload"), F.col("side._is_delete")
    if spec.drop_null_payload and keep_unreadable:
        is_delete = F.when(is_delete | payload.isNotNull(), is_delete)
    elif spec.drop_null_payload:
        rows = rows.filter(is_delete | payload.isNotNull())
    rank = F.when(op == "r", 0).when(op == "c", 1).when(is_delete, 3).otherwise(2)
    decoded = rows.select(
        *[_column(payload, spec, f).alias(f.name) for f in spec.payload.fields],
        is_delete.alias("_is_delete"),
        F.when(is_delete, DELETE_OP).otherwise(op).alias("_operation"),
        F.col("source.lsn").try_cast("bigint").alias("_lsn"),
        F.coalesce(F.col("ts_ms").try_cast("bigint"), F.col("source.ts_ms").try_cast("bigint"), "_seen_ms").alias("_ts_ms"),
        "_partition",
        "_offset",
        rank.alias("_rank"),
        *[F.when(is_delete.isNull(), F.col(c)).alias(c) for c in extra],
    )
    return _with_times(decoded, spec.payload.fields)


def fill_defaults(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """0, '' and the epoch in place of missing values, as the real-time tables store them."""
    filled = {f.name: F.coalesce(F.col(f.name), _zero(f.dataType)) for f in spec.payload.fields}
    return changes.withColumns(filled)


def decode_upserts(raw: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Created, updated and snapshot rows with ``_processing_time`` and ``_operation``."""
    rows = decode_changes(raw, spec).filter(~F.col("_is_delete"))
    if spec.zero_defaults:
        rows = fill_defaults(rows, spec)
    return rows.select(
        *spec.payload.names, F.current_timestamp().alias("_processing_time"), "_operation", *ORDER
    )


def decode_deletes(raw: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Key of every deleted row with ``_deleted_at``."""
    rows = decode_changes(raw, spec).filter(F.col("_is_delete") & (F.col("_operation") == DELETE_OP))
    return rows.select(*spec.key, F.current_timestamp().alias("_deleted_at"), *ORDER)


def infer_payload_schema(raw: DataFrame, long_keys: tuple[str, ...] = ("time",)) -> T.StructType:
    """Envelope type that fits the ``after`` side of all records; columns in the order of their names.

    One aggregate merges the records' types; only the merged type comes to the driver. A column that is missing in all
    records has no place in it, one that is null in all or differs in kind is text.
    """
    after = F.get_json_object("value", "$.after")
    merged = raw.where(after.startswith("{")).agg(F.schema_of_variant_agg(F.try_parse_json(after)).alias("kind")).first()["kind"]
    kinds = []
    if merged and merged.startswith("OBJECT<"):
        kinds = raw.sparkSession.createDataFrame([], f"after {merged.replace('OBJECT<', 'STRUCT<')}").schema["after"].dataType.fields
    fields = []
    for field in kinds:
        kind: T.DataType = schemas.STRING
        if field.name in long_keys:
            kind = schemas.LONG
        elif isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            kind = schemas.FLOAT
        elif isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
            kind = schemas.INT
        fields.append(T.StructField(field.name, kind))
    payload = T.StructType(fields) if fields else schemas.WEATHER
    if not fields:
        payload = T.StructType(
            [T.StructField(f.name, schemas.LONG if f.name in long_keys else f.dataType) for f in payload.fields]
        )
    before = T.StructType([T.StructField(k, schemas.LONG) for k in long_keys])
    return T.StructType(
        [T.StructField("op", schemas.STRING), T.StructField("after", payload), T.StructField("before", before)]
    )
