"""Vector code compression: codebooks over the parts of whole-number vectors, searched by Walsh-Hadamard transforms.

Components become whole numbers, floor(``scale`` * x); vectors are cut into ``parts`` equal consecutive parts, and every part
position has a codebook of ``entries`` entries, fitted in ``rounds`` rounds.

The nearest entry of a part is found without floating point. Parts and entries are filled up with zeros to a power of two W
and go through the Walsh-Hadamard transform, which adds and subtracts only and multiplies every squared distance by W
exactly. Squared differences are added up in sequency order (rows of the transform by their number of sign changes, where
smooth parts have their weight). An entry goes as soon as its sum exceeds the whole distance of one entry that is known.

A round is one pass over the stored whole numbers: each batch adds up its parts per entry, and Spark adds up those
sums, so ``parts`` * ``entries`` rows reach the driver whatever the input. The codebooks, of that size too, go out with
the next pass.

Defined results: a vector that is null, or holds a null, NaN or infinite component, is dropped; shorter vectors are filled
up with zeros to the longest, and that to a multiple of ``parts``. Codebooks start from the smallest ``entries`` different vec_ids (no id
comes last; of several rows with one id, the smallest components), fewer if there are not so many. Repeated rows
are rows like others. Extra columns are ignored. No rows give no rows. Components that could make a squared distance
leave 62 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import common, vectors


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform along the last axis, a power of two long, by sums and differences; rows of the transform in natural order."""
    width = x.shape[-1]
    step = 1
    while step < width:
        pairs = x.reshape(*x.shape[:-1], width // (2 * step), 2, step)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(*x.shape)
        step *= 2
    return x


def by_sequency(width: int) -> np.ndarray:
    """The transform's rows in order of their sign changes."""
    rows = hadamard(np.eye(width, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


class Books:
    """``entries`` is (parts, entries, width of a part), whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.padded = 1 << (entries.shape[2] - 1).bit_length()
        self.order = by_sequency(self.padded)
        self.turned = [self.spectrum(e) for e in entries]

    def spectrum(self, rows: np.ndarray) -> np.ndarray:
        """Zero-padded, transformed, in sequency order."""
        wide = np.zeros((len(rows), self.padded), np.int64)
        wide[:, : rows.shape[1]] = rows
        return hadamard(wide)[:, self.order]

    def nearest(self, part: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry, the lowest of those at the same distance, and its squared distance."""
        own, entries = self.spectrum(rows), self.turned[part]
        n, k = len(own), len(entries)
        sums = (own[:, :1] - entries[None, :, 0]) ** 2
        likely = sums.argmin(axis=1)
        bound = ((own - entries[likely]) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= bound[:, None])
        sums = sums[row, entry]
        for at in range(1, self.padded):
            sums = sums + (own[row, at] - entries[entry, at]) ** 2
            left = sums <= bound[row]
            row, entry, sums = row[left], entry[left], sums[left]
        # ``likely`` itself is never eliminated, so every row is still there; entries stand in ascending order.
        order = np.lexsort((entry, sums, row))
        first = order[np.searchsorted(row[order], np.arange(n))]
        return entry[first], sums[first] // self.padded

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts): codes and squared distances."""
        width = self.entries.shape[2]
        told = [self.nearest(p, rows[:, p * width : (p + 1) * width]) for p in range(len(self.entries))]
        return np.stack([c for c, _ in told], axis=1), np.stack([d for _, d in told], axis=1)

    def moved(self, totals: dict[tuple[int, int], tuple[int, list[int]]]) -> Books:
        """Every entry at the floor of the mean of its parts; an entry without parts stays."""
        entries = self.entries.copy()
        for (p, e), (count, sums) in totals.items():
            entries[p, e] = [s // count for s in sums]
        return Books(entries)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _whole(scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            here, rows = vectors.whole(batch.column(1), scale, dims)
            # A difference of two parts has at most twice this, and the transform adds up ``dims`` of them at most.
            if rows.size and 4 * dims * dims * np.abs(rows).max() ** 2 >= 2.0**62:
                raise ValueError(f"{scale} * x is too large for exact squared distances over {dims} components")
            take = pa.array(here)
            columns = [batch.column(0).take(take), batch.column(2).take(take), vectors.packed(rows.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code"])

    return run


def _rows(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whole numbers) of a few thousand rows at a time."""
    data, bounds = batch.column("code"), 4096
    for at in range(0, batch.num_rows, bounds):
        yield at, vectors.unpacked(b"".join(data.slice(at, bounds).to_pylist()), "<i8", dims)


def _sums(shared, dims: int):
    """Per batch, part and entry: how many parts, and their componentwise sum."""

    def run(batches: Iterator[pa.RecordBatch]):
        books: Books = shared.value
        parts, k, width = books.entries.shape
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            for _, rows in _rows(batch, dims):
                codes, _ = books.assign(rows)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    own, first = np.unique(codes[order, p], return_index=True)
                    count[p] += np.bincount(codes[:, p], minlength=k)
                    total[p, own] += np.add.reduceat(rows[order, p * width : (p + 1) * width], first, axis=0)
        part, entry = np.nonzero(count)
        sums = pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": count[part, entry], "sums": sums})

    return run


def _codes(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]):
        books: Books = shared.value
        for batch in batches:
            for at, rows in _rows(batch, dims):
                codes, far = books.assign(rows)
                text = [c.tobytes().hex() for c in codes.astype(np.uint8)]
                part = batch.slice(at, len(rows))
                columns = [part.column("vec_id"), part.column("label"), pa.array(text), pa.array(far.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


def stored(embeddings: DataFrame, scale: int = 4096, parts: int = 8) -> tuple[DataFrame, int]:
    """(vec_id, label, code): the whole numbers of the vectors that are kept, stored; and how many numbers each has."""
    common.importable(embeddings.sparkSession)
    longest = embeddings.agg(F.max(F.when(_kept(), F.size("embedding")))).first()[0] or 0
    dims = max(1, -(-longest // parts)) * parts
    rows = embeddings.select("vec_id", "embedding", "label").mapInArrow(_whole(scale, dims), f"vec_id {_kind(embeddings, 'vec_id')}, label {_kind(embeddings, 'label')}, code binary")
    return common.saved(rows), dims


def _kept():
    """A whole vector of finite components; NaN and the infinities are those that are not below infinity in size."""
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.col("embedding").isNotNull() & fine


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def start(rows: DataFrame, dims: int, parts: int, entries: int) -> Books:
    """Codebooks of the smallest vec_ids' parts."""
    numbers = lambda code: tuple(np.frombuffer(code, "<i8").tolist())
    ids = rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries)
    chosen = [r.vec_id for r in ids.collect()]  # ``entries`` ids at most
    wanted = F.col("vec_id").isin([i for i in chosen if i is not None])
    if None in chosen:
        wanted = F.coalesce(wanted, F.lit(False)) | F.col("vec_id").isNull()
    # One row an id: the smallest components, compared as numbers, which the bytes are not.
    least = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.conv(F.hex(F.reverse(F.substring("code", i * 8 + 1, 8))), 16, -10).cast("long"))
    first = rows.where(wanted).groupBy("vec_id").agg(F.min(F.struct(least.alias("key"), F.col("code"))).alias("least"))
    found = {r.vec_id: numbers(r.least["code"]) for r in first.collect()}
    table = np.array([found[i] for i in chosen], np.int64).reshape(-1, parts, dims // parts)
    return Books(np.ascontiguousarray(table.transpose(1, 0, 2)))


def fit(rows: DataFrame, dims: int, parts: int = 8, entries: int = 16, rounds: int = 6) -> Books:
    """The codebooks after all rounds."""
    books = start(rows, dims, parts, entries)
    context = rows.sparkSession.sparkContext
    width = dims // parts
    for _ in range(rounds):
        shared = context.broadcast(books)
        sums = rows.select("code").mapInArrow(_sums(shared, dims), "part int, entry int, n long, sums array<long>")
        adds = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
        totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *adds).collect()  # parts * entries rows at most
        books = books.moved({(r.part, r.entry): (r.n, [r[f"s{i}"] for i in range(width)]) for r in totals})
        shared.unpersist()
    return books


def compress(embeddings: DataFrame, scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is kept."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows, dims = stored(embeddings, scale, parts)
    result = f"vec_id {_kind(rows, 'vec_id')}, label {_kind(rows, 'label')}, code string, error long"
    if rows.isEmpty():
        coded = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        sha = ""
    else:
        books = fit(rows, dims, parts, entries, rounds)
        coded = common.saved(rows.mapInArrow(_codes(rows.sparkSession.sparkContext.broadcast(books), dims), result))
        sha = books.sha256()
    # Sums of labels are a table of their own; the join has a shuffle of its own on both sides, so a hot label can be split.
    key = [F.coalesce("label", F.lit(0)).alias("label"), F.col("label").isNull().alias("none")]
    sums = coded.select(*key, "error").groupBy("label", "none").agg(F.sum("error").alias("label_error"))
    salt = F.xxhash64("label", "none").alias("salt")
    left = coded.select("vec_id", "code", "error", *key).select("*", salt)
    joined = left.join(sums.select("*", salt), ["salt", "label", "none"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def report_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The result in SQL, for vectors of one size that ``parts`` divides: one step of assignment and means after another."""
    steps = [
        f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT r, (i * {parts}) // len(e) AS part, i % (len(e) // {parts}) AS pos, e[i + 1] AS x
  FROM kept, LATERAL (SELECT unnest(range(len(e))) AS i)
), b0 AS MATERIALIZED (
  SELECT part, pos, rank - 1 AS entry, x
  FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) AS rank FROM kept QUALIFY rank <= {entries}) USING (r)
)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT r, part, entry, sum((p.x - b.x) * (p.x - b.x))::BIGINT AS d FROM p JOIN b{k} b USING (part, pos) GROUP BY ALL)
  GROUP BY ALL
)""")
        if k < rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.pos, b.entry, coalesce(m.x, b.x) AS x
  FROM b{k} b LEFT JOIN (
    SELECT part, pos, entry, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM p JOIN a{k} USING (r, part) GROUP BY ALL
  ) m USING (part, pos, entry)
)""")
    steps.append(f"""coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


#: The result in SQL at the default parameters.
REPORT_SQL = report_sql()
