"""Windows that repeat, found bucket by bucket: the part that the two substring operators share.

A text is cut into pieces, runs of consecutive windows with one minimiser. Equal windows have equal minimisers, so only
pieces of one minimiser are ever compared.

1. ``candidates``: pieces whose minimiser occurs twice or more, as narrow rows (place, hashes), no text. The count of a
   frequent minimiser is summed before the shuffle.
2. ``distinct``: one row per different piece, with its first place and its number of places. A thousand copies of a
   passage are one row from here on.
3. ``contested``: pieces that share their minimiser with a different piece (or hold it twice). Only of these, and only
   of one place each, is the text fetched and sent to its bucket.

A minimiser with more than ``hot`` different pieces would make one bucket large. Its pieces are cut further, into single
windows that are dealt by a hash of the whole window, and equal ones are pre-aggregated; no task needs the minimiser's
rows together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays, common

PLACE = ["_id", "_text_hash", "start"]

#: Pieces and windows of hot ones that a task holds before they go out, whatever its batches.
ROWS = 1 << 15

Units = Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, int]]]


def byte_units(data: np.ndarray, bounds: np.ndarray, block: int, window: int):
    """(unit hashes, bounds among them, first row, offset of the first unit in that row) by groups of texts."""
    for d, e, low, high in arrays.chunks(bounds, block, window - 1):
        yield arrays.BYTE_HASH[data[low:high]], np.clip(bounds[d : e + 1], low, high) - low, d, low - int(bounds[d])


def word_units(data: np.ndarray, bounds: np.ndarray, block: int, window: int):
    starts, ends, first = arrays.word_spans(data, bounds)
    hashes = arrays.word_hashes(data, starts, ends)
    for d, e, low, high in arrays.chunks(first, block, window - 1):
        yield hashes[low:high], np.clip(first[d : e + 1], low, high) - low, d, low - int(first[d])


def _cut(units, window: int, gram: int, longest: int, block: int, counts_only: bool):
    def pieces_of(column: pa.Array):
        data, bounds = arrays.text_bytes(column)
        for unit, edges, row, shift in units(data, bounds, block, window):
            found = arrays.pieces(unit, edges, window, gram, longest)
            if found is not None:
                found["start"] = found["start"] - edges[found["row"]] + np.where(found["row"] == 0, shift, 0)
                found["row"] = found["row"] + row
                yield found

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for rows in range(0, batch.num_rows, 2000):
                part = batch.slice(rows, 2000)
                for found in pieces_of(part.column("text")):
                    if counts_only:
                        mini, place = np.unique(found["mini"], return_inverse=True)
                        weight = np.bincount(place, 1 + found["loops"]).astype(np.int64)
                        yield pa.RecordBatch.from_pydict({"mini": mini, "weight": weight})
                    else:
                        take = pa.array(found["row"])
                        yield pa.RecordBatch.from_pydict(
                            {
                                "mini": found["mini"],
                                "piece": found["piece"],
                                "_id": part.column("_id").take(take),
                                "_text_hash": part.column("_text_hash").take(take),
                                "start": found["start"],
                                "n": found["n"],
                                "loops": found["loops"],
                            }
                        )

    return run


def candidates(docs: DataFrame, units, window: int, gram: int, longest: int = 4096, block: int = 1 << 18) -> DataFrame:
    """(mini, piece, _id, _text_hash, start, n, loops) of the pieces whose minimiser stands in more than one place."""
    rows = common.keyed(docs).select("_id", "_text_hash", "text")
    counts = rows.select("text").mapInArrow(_cut(units, window, gram, longest, block, True), "mini long, weight long")
    repeated = counts.groupBy("mini").agg(F.sum("weight").alias("weight")).where("weight > 1").select("mini")
    schema = "mini long, piece long, _id long, _text_hash long, start long, n long, loops boolean"
    return common.in_both(rows.mapInArrow(_cut(units, window, gram, longest, block, False), schema), repeated, "mini")


def distinct(found: DataFrame) -> DataFrame:
    """(mini, piece, first, n, loops, places): each different piece with its first place."""
    return found.groupBy("mini", "piece").agg(
        F.min(F.struct(*PLACE)).alias("first"), F.max("n").alias("n"), F.max("loops").alias("loops"), F.count("*").alias("places")
    )


def contested(unique: DataFrame, hot: int) -> DataFrame:
    """The different pieces to compare with others, with ``hot`` telling those of a large bucket."""
    per_mini = unique.groupBy("mini").agg(F.count("*").alias("rivals"), F.max("loops").alias("any_loop"))
    per_mini = per_mini.where("rivals > 1 OR any_loop").select("mini", (F.col("rivals") > hot).alias("hot"))
    return unique.join(per_mini, "mini")


def with_lists(docs: DataFrame, items: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Each document's row (doc_id, _id, _text_hash, text) with ``items``: what ``items`` says of it, each thing once.

    Rows that agree in id and text say the same of one another; every task reduces that to one before the shuffle.
    """
    lists = items.groupBy("_id", "_text_hash").agg(F.collect_set(F.struct(*columns)).alias("items"))
    return common.keyed(docs).join(lists, ["_id", "_text_hash"], how).select("doc_id", "_id", "_text_hash", "text", "items")
