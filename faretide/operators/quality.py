"""Row checks. A row is rejected when a rule holds; a rule that is NULL does not reject."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions import measures

VALID, REJECTED = "VALID", "REJECTED"


@dataclass(frozen=True)
class Rule:
    name: str
    status_column: str
    reject_when: str  # SQL predicate


# What counts as a bad row, and the names of the status columns.
RULES: dict[str, tuple[Rule, ...]] = {
    "trips": (
        Rule("vendor missing", "_quality_status", "vendorid IS NULL"),
        Rule("pickup missing", "_pickup_status", "tpep_pickup_datetime IS NULL"),
        Rule("dropoff missing", "_dropoff_status", "tpep_dropoff_datetime IS NULL"),
        Rule("fare negative", "_fare_status", "fare_amount < 0"),
        Rule("distance negative", "_distance_status", "trip_distance < 0"),
    ),
    "weather": (
        Rule("time missing", "_time_status", "time IS NULL"),
        Rule("temperature missing", "_temp_status", "temperature IS NULL"),
        Rule("temperature out of range", "_temp_range", "temperature < -100 OR temperature > 100"),
    ),
}


def fails(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.reject_when), F.lit(False))


def passes(rules: tuple[Rule, ...]) -> Column:
    bad = F.lit(False)
    for rule in rules:
        bad = bad | fails(rule)
    return ~bad


def tag(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One VALID/REJECTED column per rule."""
    return df.withColumns({r.status_column: F.when(fails(r), REJECTED).otherwise(VALID) for r in rules})


def accept(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The rows no rule rejects, unchanged."""
    return df.filter(passes(rules))


def reject(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The other rows, with the names of the rules they break in ``reject_reasons``."""
    reasons = F.array_compact(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]))
    return df.filter(~passes(rules)).withColumn("reject_reasons", reasons)


def reject_counts(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rejected rows per broken rule; a row that breaks two counts under both."""
    broken = reject(df, rules).select(F.explode("reject_reasons").alias("rule"))
    return broken.groupBy("rule").agg(F.count("*").alias("rejected"))


def null_non_finite(df: DataFrame) -> DataFrame:
    """NULL in place of NaN and the infinities, in every float column, structs and arrays included."""

    def clean(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return measures.finite(value)
        if isinstance(kind, T.StructType) and holds_float(kind):
            parts = [clean(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*parts))
        if isinstance(kind, T.ArrayType) and holds_float(kind):
            return F.transform(value, lambda item: clean(item, kind.elementType))
        return value

    def holds_float(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return any(holds_float(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return holds_float(kind.elementType)
        return isinstance(kind, (T.FloatType, T.DoubleType))

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
