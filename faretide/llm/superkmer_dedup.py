r"""Passages of many words that occur twice: super-k-mer partitioning.

A window is ``window`` consecutive words. Consecutive windows that share their minimiser (the smallest hash of ``gram``
words) travel as one packed string to the minimiser's bucket, where the windows are sorted and counted on their words.
Every word of a window that also starts elsewhere is removed, in all its places.

Which pieces travel: see ``buckets``. Pieces that only occur as exact copies of one another are counted without their
text; of all others, one place each is packed and sent. Buckets of very frequent minimisers are dealt by whole windows.

Defined results: a null or empty text has no words; documents shorter than a window lose nothing; rows with equal
doc_id and text are two documents and so repeat each other; a null doc_id is an id of its own; extra columns are ignored.
Pieces are told apart by 128 bits of hashes (minimiser and content), windows within a bucket by their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays, buckets, common


def _pack(window: int):
    """One place of each contested piece as a packed string; of hot ones each different window by hash, equal ones together.

    Rows go out as soon as ``buckets.ROWS`` pieces and windows are held.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        out: dict[str, list] = {k: [] for k in PACKED.names}
        windows: dict[bytes, list] = {}
        waiting = 0

        def put(*row):
            for name, value in zip(out, row):
                out[name].append(value)

        def packed() -> pa.RecordBatch:
            for digest, (places, members) in windows.items():
                put(None, None, places, True, *np.frombuffer(digest, np.int64).tolist(), None, members)
            rows = pa.RecordBatch.from_pydict(out, schema=PACKED)
            windows.clear()
            for values in out.values():
                values.clear()
            return rows

        for batch in batches:
            for text, pieces in zip(batch.column("text"), batch.column("items")):
                words = text.as_py().encode().split()
                for item in pieces:
                    item = item.as_py()
                    begin, n, places = item["start"], item["n"], item["places"]
                    part = words[begin : begin + n + window - 1]
                    if not item["hot"]:
                        put(item["mini"], item["piece"], places, False, None, None, b" ".join(part), None)
                        waiting += 1
                    else:
                        of_piece: dict[bytes, list] = {}
                        for k in range(n):
                            digest = hashlib.blake2b(b" ".join(part[k : k + window]), digest_size=16).digest()
                            of_piece.setdefault(digest, []).append({"at": k, "n": 1})
                        for digest, runs in of_piece.items():
                            held = windows.setdefault(digest, [0, []])
                            held[0] += places * len(runs)
                            held[1].append({"mini": item["mini"], "piece": item["piece"], "runs": runs})
                        waiting += n
                    if waiting >= buckets.ROWS:
                        yield packed()
                        waiting = 0
        if waiting:
            yield packed()

    return run


RUN_LIST = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))
MEMBERS = pa.list_(pa.struct([("mini", pa.int64()), ("piece", pa.int64()), ("runs", RUN_LIST)]))
PACKED = pa.schema(
    [(k, pa.int64()) for k in ("mini", "piece", "places")]
    + [("hot", pa.bool_()), ("hash_1", pa.int64()), ("hash_2", pa.int64()), ("packed", pa.binary()), ("members", MEMBERS)]
)
PACKED_SQL = (
    "mini long, piece long, places long, hot boolean, hash_1 long, hash_2 long, packed binary, "
    "members array<struct<mini:bigint,piece:bigint,runs:array<struct<at:bigint,n:bigint>>>>"
)


def count_windows(packed: list[bytes], places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, window in it, total places) of all windows, counted by sorting; equal means equal words."""
    numbers: dict[bytes, int] = {}
    lists = [p.split(b" ") for p in packed]
    sizes = np.array([len(x) for x in lists])
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for x in lists for w in x), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    n = sizes - window + 1
    string = np.repeat(np.arange(len(packed)), n)
    at = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
    start = first[string] + at
    hashes = arrays.Ranges(arrays.mix(ids.astype(np.uint64) + np.uint64(1))).of(start, start + window)
    order = np.argsort(hashes, kind="stable")
    views = np.lib.stride_tricks.sliding_window_view(ids, window)
    sorted_hashes, rows = hashes[order], start[order]
    same_hash = np.flatnonzero(sorted_hashes[1:] == sorted_hashes[:-1])
    differs = np.zeros(len(order), bool)
    differs[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    clash = np.zeros(len(same_hash), bool)
    for lo in range(0, len(same_hash), 1 << 16):
        part = same_hash[lo : lo + (1 << 16)]
        clash[lo : lo + (1 << 16)] = (views[rows[part]] != views[rows[part + 1]]).any(1)
    if clash.any():  # two windows of one hash: sort on the words
        order = np.lexsort(views[start].T[::-1])
        rows = start[order]
        differs[1:] = (views[rows[1:]] != views[rows[:-1]]).any(1)
    group = np.cumsum(differs)
    totals = np.bincount(group, places[string[order]]).astype(np.int64)[group]
    return string[order], at[order], totals


def _count(window: int, least_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for table in arrays.whole_keys(batches, "mini", least_bytes):
            places = table.column("places").to_numpy()
            string, at, totals = count_windows(table.column("packed").to_pylist(), places, window)
            twice = totals > 1
            string, at = string[twice], at[twice]
            order = np.lexsort((at, string))
            string, at = string[order], at[order]
            if not len(string):
                continue
            edge = np.flatnonzero(np.r_[True, (string[1:] != string[:-1]) | (at[1:] != at[:-1] + 1)])
            n = np.diff(np.r_[edge, len(at)])
            take = pa.array(string[edge])
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("mini").combine_chunks().take(take),
                    table.column("piece").combine_chunks().take(take),
                    pa.array(at[edge]),
                    pa.array(n),
                ],
                names=["mini", "piece", "at", "n"],
            )

    return run


def repeated_runs(docs: DataFrame, window: int = 35, gram: int = 8, hot: int = 1024, bucket_bytes: int = 4 << 20) -> DataFrame:
    """(_id, _text_hash, start, n): runs of windows, by their first word, that also start elsewhere."""
    found = common.saved(buckets.candidates(docs, buckets.word_units, window, gram))
    unique = common.saved(buckets.distinct(found))
    copied = unique.where("places > 1").select(
        "mini", "piece", F.array(F.struct(F.lit(0).cast("long").alias("at"), F.col("n"))).alias("runs")
    )
    wanted = buckets.contested(unique, hot).select(
        "first.*", "mini", "piece", "n", "places", "hot"
    )
    packed = buckets.with_lists(docs, wanted, ["mini", "piece", "start", "n", "places", "hot"], "inner")
    packed = common.saved(packed.select("text", "items").mapInArrow(_pack(window), PACKED_SQL))
    cold = packed.where("NOT hot").select("mini", "piece", "places", "packed").repartition("mini").sortWithinPartitions("mini")
    counted = cold.mapInArrow(_count(window, bucket_bytes), "mini long, piece long, at long, n long")
    windows = packed.where("hot").select("hash_1", "hash_2", "places", "members")
    totals = windows.groupBy("hash_1", "hash_2").agg(F.sum("places").alias("total")).where("total > 1")
    totals = common.apart(totals, ["hash_1", "hash_2"], "key").select("key", "hash_2")
    twice = common.apart(windows, ["hash_1", "hash_2"], "key").join(totals, ["key", "hash_2"], "left_semi")
    frequent = twice.select(F.explode("members").alias("m")).select("m.*")
    counted = counted.select("mini", "piece", F.array(F.struct("at", "n")).alias("runs"))
    told = counted.unionByName(frequent).groupBy("mini", "piece").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    told = told.join(copied, ["mini", "piece"], "left_anti").unionByName(copied)
    hits = found.select("mini", "piece", *buckets.PLACE).join(told, ["mini", "piece"])
    run = F.explode("runs").alias("run")
    return hits.select(*buckets.PLACE, run).select("_id", "_text_hash", (F.col("start") + F.col("run.at")).alias("start"), F.col("run.n").alias("n"))


def _remove(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, counts, removed, kept = [], [], [], []
            for doc_id, text, items in zip(batch.column("doc_id"), batch.column("text"), batch.column("items")):
                words = text.as_py().encode().split()
                total = len(words)
                runs = items.as_py()
                if runs:
                    change = np.zeros(total + 1, np.int64)
                    start = np.array([r["start"] for r in runs])
                    np.add.at(change, start, 1)
                    np.add.at(change, start + np.array([r["n"] for r in runs]) + window - 1, -1)
                    stays = np.cumsum(change)[:total] == 0
                    words = [words[i] for i in np.flatnonzero(stays)]
                left = b" ".join(words)
                ids.append(doc_id.as_py())
                counts.append(total)
                removed.append(total - len(words))
                kept.append(left.decode() if keep_text else hashlib.sha256(left).hexdigest())
            names = ["doc_id", "n_words", "n_removed", "text" if keep_text else "kept_sha256"]
            arrays_ = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays_, names=names)

    return run


def dedup_passages(docs: DataFrame, window: int = 35, keep_text: bool = True, **how) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, and the words left (``text``) or their digest (``kept_sha256``)."""
    runs = repeated_runs(docs, window, **how)
    rows = buckets.with_lists(docs, runs, ["start", "n"], "left").select("doc_id", "text", "items")
    last = "text string" if keep_text else "kept_sha256 string"
    return rows.mapInArrow(_remove(window, keep_text), f"doc_id long, n_words long, n_removed long, {last}")


#: The result in SQL, for tables where every window can be spelled out.
REPORT_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS k FROM d, LATERAL (SELECT unnest(range(1, len(w) - 33)) AS i)
), again AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1
), gone AS (
  SELECT DISTINCT r, j FROM again, LATERAL (SELECT unnest(range(i, i + 35)) AS j)
), places AS (
  SELECT r, j, w[j] AS word FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS j)
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM places ANTI JOIN gone USING (r, j) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
