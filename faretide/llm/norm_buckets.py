"""Exact top-k search by inner product: norm buckets, pruned by length or by a coordinate, then verified.

Components become whole numbers, floor(``scale`` * x), and every score is an exact whole number.

1. ``buckets``: all rows are sorted by length over the cluster and cut into buckets of about ``bucket_bytes``, or where the
   length falls below 0.9 of the bucket's longest. One row a bucket, written once to the shared folder.
2. ``top_k``: queries are dealt into blocks of about ``block_queries``, buckets into ``lanes``. A task holds one block and
   lets the buckets of one lane pass, longest first. A query's k-th best score so far, over its length and the
   bucket's longest, is the cosine that a vector of this bucket needs at least, the local threshold. Above 1 the bucket is
   skipped; from ``steep`` on, only the slice of vectors is read whose value in the query's largest coordinate fits that
   angle; below, only the bucket's vectors of sufficient length are. What is left is multiplied out.
3. The lanes' lists, k rows of a query at most from each, are merged.

No pairs become rows: what leaves a task is k rows of a query. Memory of a task: one block, its lists, one bucket.
Buckets are sent to each block and queries to each lane. With one block that is in proportion to the input; past
``block_queries`` queries the buckets are sent once more, as an exact search has to show every query every bucket.

Defined results: a vector that is null, or holds a null, NaN or infinite component, takes no part; an empty one is all
zeros, as are the missing components of a shorter one. Rows that agree in vec_id and vector count once. A query meets no
row of its own vec_id. A row without vec_id is a candidate and comes last among ties. Extra columns are ignored. A
vector whose squared length reaches 2**53 is an error, as its products would not be exact. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faretide.llm import common, vectors

ROW = "vec_id long, norm long, mark long, code binary"
BUCKET = "lane int, longest long, n int, n_queries int, dims int, ids binary, marks binary, code binary"
#: Widens every bound that is computed in floating point, so that rounding cannot prune a result.
SLACK = 1e-9


def _encode(scale: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            here, rows = vectors.whole(batch.column(1), scale)
            norm = (rows * rows).sum(axis=1)
            if len(norm) and norm.max() >= vectors.EXACT:
                raise ValueError(f"the squared length of {scale} * x reaches 2**53; scores would not be exact")
            ids = batch.column(0).take(pa.array(here)).to_numpy(zero_copy_only=False)
            # Copies of a row within a batch go at once, so that even a row that is a third of all is dealt out thinly.
            codes = [r.tobytes() for r in _trimmed(rows)]
            mark = np.array([hash_of(c) for c in codes], np.int64)
            order = np.lexsort((mark, ids))
            same = np.zeros(len(order), bool)
            same[1:] = (ids[order][1:] == ids[order][:-1]) & (rows[order][1:] == rows[order][:-1]).all(axis=1)
            keep = np.sort(order[~same])
            columns = {"vec_id": ids, "norm": norm.astype(np.int64), "mark": mark, "code": pa.array(codes, pa.binary())}
            columns = {name: pa.array(c).take(pa.array(keep)) for name, c in columns.items()}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _trimmed(rows: np.ndarray) -> list[np.ndarray]:
    """As 32-bit numbers and without the zeros at the end: equal vectors are equal bytes, however far they were filled up."""
    used = (rows != 0) * np.arange(1, rows.shape[1] + 1)
    return [r[:n] for r, n in zip(rows.astype("<i4"), used.max(axis=1, initial=0).tolist())]


def hash_of(code: bytes) -> int:
    """Tells the vectors of one vec_id apart."""
    return xxhash.xxh64_intdigest(code) - 2**63


def _pack(lanes: int, bucket_bytes: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]):
        held, size, made, last = [], 0, TaskContext.get().partitionId(), None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row == last:
                    continue
                last, (_, norm, _, code) = row, row
                if held and (size + len(code) + 16 > bucket_bytes or 100 * norm < 81 * held[0][1]):
                    yield _bucket(held, made % lanes, every)
                    held, size, made = [], 0, made + 1
                held.append(row)
                size += len(code) + 16
        if held:
            yield _bucket(held, made % lanes, every)

    return run


def _bucket(held: list[tuple], lane: int, every: int) -> pa.RecordBatch:
    ids, norms, marks, codes = zip(*held)
    dims = max(1, max(map(len, codes)) // 4)
    code = b"".join(c.ljust(4 * dims, b"\0") for c in codes)
    ids = np.array(ids, "<i8")
    row = [lane, norms[0], len(ids), int(_asks(ids, every).sum()), dims, ids.tobytes(), np.array(marks, "<i8").tobytes(), code]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in BUCKET.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _asks(ids: np.ndarray, every: int) -> np.ndarray:
    return (ids % every == 0) & (ids != common.NO_ID)


def _queries(every: int):
    """The queries of each bucket, packed like a bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                asks = _asks(ids, every)
                if not asks.any():
                    continue
                marks, code = np.frombuffer(row["marks"], "<i8"), vectors.unpacked(row["code"], "<i4", row["dims"])
                found = {"n": [int(asks.sum())], "dims": [row["dims"]]}
                found |= {"ids": [ids[asks].tobytes()], "marks": [marks[asks].tobytes()], "code": [code[asks].tobytes()]}
                yield pa.RecordBatch.from_pydict(found, pa.schema([("n", pa.int32()), ("dims", pa.int32()), *((c, pa.binary()) for c in ("ids", "marks", "code"))]))

    return run


class Block:
    """The queries of one block with their best rows so far."""

    def __init__(self, rows: list[dict], k: int, steep: float):
        dims = max(r["dims"] for r in rows)
        self.ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows])
        self.marks = np.concatenate([np.frombuffer(r["marks"], "<i8") for r in rows])
        self.vectors = np.zeros((len(self.ids), dims))
        at = 0
        for r in rows:
            part = vectors.unpacked(r["code"], "<i4", r["dims"])
            self.vectors[at : at + len(part), : r["dims"]] = part
            at += len(part)
        self.length = np.sqrt((self.vectors**2).sum(axis=1))
        self.k, self.steep = k, steep
        self.scores = np.full((at, k), -np.inf)
        self.found = np.full((at, k), common.NO_ID)

    def meet(self, row: dict) -> None:
        """All rows of a bucket, in order of length, longest first."""
        dims = min(row["dims"], self.vectors.shape[1])
        ids, rows = np.frombuffer(row["ids"], "<i8"), vectors.unpacked(row["code"], "<i4", row["dims"]).astype(np.float64)
        length = np.sqrt((rows**2).sum(axis=1))
        rows = rows[:, :dims]
        theta = self.scores[:, -1]
        reach = self.length * (length[0] * (1 + SLACK))
        live = np.flatnonzero(theta <= reach)
        local = theta[live] / np.maximum(reach[live], 1e-300)
        by_angle = local >= self.steep
        self._by_coordinate(live[by_angle], local[by_angle], ids, rows, length)
        self._by_length(live[~by_angle], ids, rows, length)

    def _by_length(self, asking: np.ndarray, ids: np.ndarray, rows: np.ndarray, length: np.ndarray) -> None:
        if not len(asking):
            return
        needs = self.scores[asking, -1] / np.maximum(self.length[asking] * (1 + SLACK), 1e-300)
        upto = np.searchsorted(-length, -needs, side="right")
        order = np.argsort(upto)
        for a in range(0, len(order), 256):
            part = order[a : a + 256]
            n = int(upto[part].max())
            self._verify(asking[part], ids[:n], rows[:n])

    def _by_coordinate(self, asking: np.ndarray, local: np.ndarray, ids: np.ndarray, rows: np.ndarray, length: np.ndarray) -> None:
        """Unit vectors within the angle arccos(``local``) of the query differ from it in a coordinate by so much at most."""
        if not len(asking):
            return
        # A coordinate that the bucket lacks is zero in all its vectors.
        unit = self.vectors[asking] / self.length[asking, None]
        main = np.abs(unit[:, : rows.shape[1]]).argmax(axis=1)
        value = unit[np.arange(len(asking)), main]
        angle, spread = np.arccos(np.clip(value, -1, 1)), np.arccos(np.clip(local - SLACK, -1, 1))
        low, high = np.cos(np.minimum(np.pi, angle + spread)) - SLACK, np.cos(np.maximum(0, angle - spread)) + SLACK
        order = np.lexsort((low, main))
        edges = np.flatnonzero(np.r_[True, main[order][1:] != main[order][:-1], True])
        for a, b in zip(edges[:-1], edges[1:]):
            column = rows[:, main[order[a]]] / np.maximum(length, 1e-300)
            sorted_by = np.argsort(column)
            for c in range(a, b, 64):
                part = order[c : min(b, c + 64)]
                first = np.searchsorted(column[sorted_by], low[part].min())
                last = np.searchsorted(column[sorted_by], high[part].max(), side="right")
                chosen = sorted_by[first:last]
                self._verify(asking[part], ids[chosen], rows[chosen])

    def _verify(self, asking: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(ids):
            return
        scores = self.vectors[asking, : rows.shape[1]] @ rows.T
        by_id = np.argsort(ids)
        first, last = (np.searchsorted(ids[by_id], self.ids[asking], side=s) for s in ("left", "right"))
        for q in np.flatnonzero(last > first).tolist():
            scores[q, by_id[first[q] : last[q]]] = -np.inf
        bar = np.maximum(self.scores[asking, -1], -1e300)
        many = np.flatnonzero((scores >= bar[:, None]).sum(axis=1) > self.k)
        if len(many):
            bar[many] = np.maximum(bar[many], np.partition(scores[many], -self.k, axis=1)[:, -self.k])
        q, at = np.nonzero(scores >= bar[:, None])
        if len(q):
            self._offer(asking[q], scores[q, at], ids[at])

    def _offer(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        touched = np.unique(query)
        query = np.concatenate([query, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.scores[touched].ravel()])
        vec_id = np.concatenate([vec_id, self.found[touched].ravel()])
        order = np.lexsort((vec_id, -score, query))
        first = np.searchsorted(query[order], touched)
        best = order[first[:, None] + np.arange(self.k)]
        self.scores[touched], self.found[touched] = score[best], vec_id[best]

    def result(self) -> pa.RecordBatch:
        q, at = np.nonzero(np.isfinite(self.scores))
        score = self.scores[q, at].astype(np.int64)
        return pa.RecordBatch.from_pydict({"query_id": self.ids[q], "mark": self.marks[q], "vec_id": self.found[q, at], "score": score})


def _search(k: int, steep: float):
    def run(batches: Iterator[pa.RecordBatch]):
        cell, waiting, block = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):  # one at a time: a row is a whole bucket
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["lane"], row["block"]) != cell:
                    if block:
                        yield block.result()
                    cell, waiting, block = (row["lane"], row["block"]), [], None
                if row["bucket"]:
                    block = block or (Block(waiting, k, steep) if waiting else None)
                    if block:
                        block.meet(row)
                else:
                    waiting.append(row)
        if block:
            yield block.result()

    return run


def buckets(embeddings: DataFrame, scale: int = 64, every: int = 20, lanes: int = 24, bucket_bytes: int = 1 << 19) -> DataFrame:
    """One row per norm bucket, stored: its lane, squared length of its longest vector, and its rows in order of length."""
    spark = common.importable(embeddings.sparkSession)
    rows = embeddings.select(common.order_id("vec_id").alias("vec_id"), "embedding").mapInArrow(_encode(scale), ROW)
    by = [F.desc("norm"), F.col("vec_id"), F.col("code")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return common.saved(in_order.mapInArrow(_pack(lanes, bucket_bytes, every), BUCKET))


def top_k(
    embeddings: DataFrame,
    k: int = 20,
    scale: int = 64,
    every: int = 20,
    lanes: int = 24,
    bucket_bytes: int = 1 << 19,
    block_queries: int = 1 << 16,
    steep: float = 0.9,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each row whose vec_id is divisible by ``every``."""
    stored = buckets(embeddings, scale, every, lanes, bucket_bytes)
    asked = stored.agg(F.sum("n_queries")).first()[0] or 0
    blocks = max(1, -(-asked // block_queries))
    schema = "n int, dims int, ids binary, marks binary, code binary"
    queries = stored.where("n_queries > 0").select("n", "dims", "ids", "marks", "code").mapInArrow(_queries(every), schema)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("ids", "marks"), F.lit(blocks)).cast("int"))
    queries = queries.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    shown = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    columns = ["lane", "block", "bucket", "longest", "dims", "ids", "marks", "code"]
    both = queries.withColumns({"bucket": F.lit(False), "longest": F.lit(0).cast("long")}).select(*columns)
    both = both.unionByName(shown.withColumn("bucket", F.lit(True)).select(*columns))
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = both.repartition(min(lanes * blocks, 8 * parts), "lane", "block")
    cells = cells.sortWithinPartitions("lane", "block", "bucket", F.desc("longest"))
    lists = cells.mapInArrow(_search(k, steep), "query_id long, mark long, vec_id long, score long")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    known = F.when(F.col("vec_id") != common.NO_ID, F.col("vec_id")).alias("vec_id")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), known, "score")


#: The result in SQL, for tables where every pair can be multiplied out.
REPORT_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score
FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
