"""Connected components by alternating large and small stars; the state lives in tables, never on the driver.

Links that one task can hold, ``AT_ONCE`` at most, are joined in one pass of one task instead; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.llm import common

#: Links of two 16-byte nodes; a task needs some hundred bytes for each.
AT_ONCE = 1 << 16


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``m``: the least of u and all its neighbours. A hub's edges keep a shuffle Spark can split."""
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    key = F.xxhash64("u").alias("key")
    return edges.select("u", "v", key).join(least.select("u", "m", key), ["key", "u"]).select("u", "v", "m")


def _arrow(kind: T.DataType) -> pa.DataType:
    """Of a long, or a struct of longs."""
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, pa.int64()) for f in kind.fields])
    return pa.int64()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _joined(kind: pa.DataType):
    """All links in one task: each node under the smallest of its component."""

    def run(batches: Iterator[pa.RecordBatch]):
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        flat = not pa.types.is_struct(kind)
        for batch in batches:
            ends = [c.to_pylist() if flat else list(zip(*(f.to_pylist() for f in c.flatten()))) for c in (batch.column("u"), batch.column("v"))]
            for u, v in zip(*ends):
                low, high = sorted((root(u), root(v)))
                parent[high] = low
        nodes = list(parent)
        for at in range(0, len(nodes), 10_000):
            columns = []
            for rows in (nodes[at : at + 10_000], [root(x) for x in nodes[at : at + 10_000]]):
                columns.append(pa.array(rows if flat else [dict(zip((f.name for f in kind), x)) for x in rows], kind))
            yield pa.RecordBatch.from_arrays(columns, names=["node", "component"])

    return run


def components(edges: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(node, component) of every node of the links (u, v); the component is its smallest node. Nodes are never null."""
    stars = common.saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(stars)
    if before[0] <= at_once:
        node = stars.schema["u"].dataType
        schema = T.StructType([T.StructField("node", node), T.StructField("component", node)])
        return stars.coalesce(1).mapInArrow(_joined(_arrow(node)), schema)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        joined = _with_least(large.where("u <> v"))
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = joined.select(F.explode(pairs).alias("e")).select("e.*").where("u <> v").distinct()
        stars = common.saved(small)
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
