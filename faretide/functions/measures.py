"""Money, distance and other measures with a fixed number of decimals.

Measures arrive as FLOAT or DOUBLE. Adding doubles gives a result that depends on the order of
the rows, so a retried task could change a report. Every sum here runs over whole units of a measure's
last decimal (``MONEY``: hundredths; ``DISTANCE``, ``FINE``: smaller ones) held in a BIGINT: exact, independent of order, as fast as a double sum (it stays in generated code),
and partial sums of it can be added again without loss. An overflow is an error under ANSI mode,
never a silent wrap. NaN and the infinities count as missing values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")

#: Decimals: of money; of distances, which may come as FLOAT and so have seven digits that count; of other doubles.
#: A BIGINT holds totals of 9 * 10**16, 9 * 10**14 and 9 * 10**12 of them.
MONEY = 2
DISTANCE = 4
FINE = 6


def finite(value: Column) -> Column:
    """NULL in place of NaN and the infinities (NaN compares above infinity in Spark)."""
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def at_least(value: Column, low: float) -> Column:
    """``value``, or ``low`` where it is smaller; a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low).cast("double")))


def units(value: Column, decimals: int) -> Column:
    return F.rint(finite(value).cast("double") * 10**decimals).cast("bigint")


def exact_sum(value: Column, decimals: int = MONEY, weight: Column | None = None) -> Column:
    """The sum of the values, each rounded to ``decimals``, and times a whole ``weight`` if there is one."""
    whole = units(value, decimals)
    return F.sum(whole if weight is None else whole * weight) / F.lit(10.0**decimals)


def value_count(value: Column) -> Column:
    """How many values take part in :func:`exact_sum`."""
    return F.count(finite(value))


def exact_mean(value: Column, decimals: int = MONEY) -> Column:
    return ratio(exact_sum(value, decimals), value_count(value))


def ratio(total: Column, count: Column) -> Column:
    """``total / count``, NULL where there is nothing to divide by."""
    return F.try_divide(total, count.cast("double"))


def rounded(value: Column, digits: int) -> Column:
    """Decimal half-up rounding that does not depend on the binary form of the double."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")
