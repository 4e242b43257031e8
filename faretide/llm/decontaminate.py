r"""Benchmark decontamination by greedy string tiling.

Words are ``[^\x20\x09-\x0D]+`` without bytes that are ASCII punctuation, A-Z in lower case. Benchmark items meet a text by shared runs
of ``seed`` words. For each pair, the longest common runs not yet tiled are marked, again and again, down to ``seed``
words: running Karp-Rabin hashes of falling length, compared where seeds are shared, tell the longest. Tiles may
come in any order, so a passage whose sentences were moved is covered all the same. An item whose tiles cover
``coverage`` of its words is in the document.

The benchmark is a table of questions, not a corpus. It passes through the driver in blocks of at most ``block_words`` words, and
each block is broadcast by itself and meets all texts in one scan. Texts are never shuffled. All blocks are made before the
scan begins, so the driver holds the whole benchmark.

Defined results: a null text holds nothing; an item with fewer than ``seed`` words must stand whole, as one run, and
an item without words is in no document; repeated rows and items are judged each on its own; a null doc_id is kept as
null; extra columns are ignored by ``leaks``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays, common

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters, digits and all bytes beyond ASCII make words.
INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

LEAKS = "doc_id long, item_id long, covered long, item_words long, coverage double, tiles array<struct<item_at:bigint,doc_at:bigint,words:bigint>>"


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and where each text's begin."""
    data, bounds = arrays.text_bytes(column)
    data = LOWER[data]
    starts, ends, first = arrays.word_spans(data, bounds, INSIDE)
    return arrays.word_hashes(data, starts, ends), first


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """A Karp-Rabin hash of every run of ``size`` words."""
    out = np.zeros(max(0, len(words) - size + 1), U)
    for j in range(size):
        out = out * U(arrays._BASE) + words[j : j + len(out)]
    return arrays.mix(out)


def tile(item: np.ndarray, text: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the item, place in the text, words): longest first, none overlapping in either.

    A common run begins at a seed, so for each length the running hashes of item and text are compared there. A run of
    some length that is free and common stays so when it is cut, so the longest length is found by halving. Of equal ones
    the first in the item is marked first, then the first in the text. Equal hashes are confirmed word by word.
    """
    at, to = (np.array(x, np.int64) for x in zip(*sorted(seeds)))
    of_item, of_text = arrays.Ranges(item), arrays.Ranges(text)
    taken_item, taken_text = np.zeros(len(item) + 1, np.int64), np.zeros(len(text) + 1, np.int64)  # words tiled before a place

    def common_runs(size: int) -> tuple[np.ndarray, np.ndarray]:
        inside = (at + size <= len(item)) & (to + size <= len(text))
        a, b = at[inside], to[inside]
        free = (taken_item[a + size] == taken_item[a]) & (taken_text[b + size] == taken_text[b])
        a, b = a[free], b[free]
        same = of_item.of(a, a + size) == of_text.of(b, b + size)
        return a[same], b[same]

    open_item, open_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles, longest = [], min(len(item), len(text))
    while longest >= least:
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            if len(common_runs(middle)[0]):
                low = middle
            else:
                high = middle - 1
        longest = low
        if longest < least:
            break
        runs = list(zip(*(x.tolist() for x in common_runs(longest))))
        for a, b in runs:
            i, j = slice(a, a + longest), slice(b, b + longest)
            if open_item[i].all() and open_text[j].all():
                if not np.array_equal(item[i], text[j]):
                    raise ArithmeticError("two different runs of words have one 64-bit hash")
                open_item[i] = open_text[j] = False
                tiles.append((a, b, longest))
        taken_item[1:], taken_text[1:] = np.cumsum(~open_item), np.cumsum(~open_text)
    return tiles


class Block:
    """A bounded part of the benchmark, with its seeds sorted for search."""

    def __init__(self, ids: list, texts: list, seed: int, coverage: float):
        self.seed, self.coverage = seed, coverage
        words, first = tokens(pa.array(texts, pa.string()))
        self.items = [(i, words[a:b]) for i, a, b in zip(ids, first[:-1], first[1:]) if b > a]
        hashes, owner, place = [], [], []
        self.sizes = sorted({min(seed, len(w)) for _, w in self.items})
        self.seeds = {}
        for size in self.sizes:
            of = [k for k, (_, w) in enumerate(self.items) if min(seed, len(w)) == size]
            parts = [runs_of(self.items[k][1], size) for k in of]
            hashes = np.concatenate(parts)
            owner = np.repeat(of, [len(p) for p in parts])
            place = np.concatenate([np.arange(len(p)) for p in parts])
            order = np.argsort(hashes, kind="stable")
            self.seeds[size] = (hashes[order], owner[order], place[order])
        self.filter = {}
        for size, (hashes, _, _) in self.seeds.items():
            bits = np.zeros(1 << 20, bool)
            bits[hashes >> U(44)] = True
            self.filter[size] = bits

    def find(self, column: pa.Array) -> Iterator[tuple[int, int, list]]:
        """(row, item, tiles) of the items that are covered enough."""
        words, first = tokens(column)
        seeds: dict[tuple[int, int], list] = defaultdict(list)
        for size in self.sizes:
            hashes, owner, place = self.seeds[size]
            runs = runs_of(words, size)
            at = np.flatnonzero(self.filter[size][runs >> U(44)])
            low, high = np.searchsorted(hashes, runs[at]), np.searchsorted(hashes, runs[at], side="right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + size <= first[row + 1]
            for r, b, x, y in zip(row[inside].tolist(), at[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
                for k in range(x, y):
                    seeds[r, int(owner[k])].append((int(place[k]), b - int(first[r])))
        for (row, k), pairs in sorted(seeds.items()):
            item = self.items[k][1]
            text = words[first[row] : first[row + 1]]
            tiles = tile(item, text, pairs, min(self.seed, len(item)))
            if sum(t[2] for t in tiles) >= self.coverage * len(item):
                yield row, k, tiles


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]):
        block = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "covered", "item_words", "coverage", "tiles")}
                for row, k, tiles in block.find(batch.column("text")):
                    item_id, words = block.items[k]
                    covered = sum(t[2] for t in tiles)
                    told = [{"item_at": a, "doc_at": b, "words": n} for a, b, n in sorted(tiles)]
                    for name, value in zip(out, (batch.column("doc_id")[row].as_py(), item_id, covered, len(words), covered / len(words), told)):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=RESULT)

    return run


TILES = pa.list_(pa.struct([("item_at", pa.int64()), ("doc_at", pa.int64()), ("words", pa.int64())]))
RESULT = pa.schema(
    [(k, pa.int64()) for k in ("doc_id", "item_id", "covered", "item_words")] + [("coverage", pa.float64()), ("tiles", TILES)]
)


def blocks(benchmark: DataFrame, seed: int, coverage: float, block_words: int) -> Iterator[Block]:
    """The benchmark, streamed to the driver, in blocks; a single item may be longer than a block."""
    ids, texts, held = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit(""))).toLocalIterator():
        size = len(row[1].split())
        if held and held + size > block_words:
            yield Block(ids, texts, seed, coverage)
            ids, texts, held = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        held += size
    if ids:
        yield Block(ids, texts, seed, coverage)


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.6, block_words: int = 1_000_000) -> DataFrame:
    """A row for each document and benchmark item in it: how much of the item is covered, and the tiles."""
    if not 0 < coverage <= 1 or seed < 1:
        raise ValueError("coverage is a share above 0, seed at least one word")
    spark = common.importable(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = spark.createDataFrame([], LEAKS)
    for k, block in enumerate(blocks(benchmark, seed, coverage, block_words)):
        part = texts.mapInArrow(_scan(spark.sparkContext.broadcast(block)), LEAKS)
        found = found.unionByName(part) if k else part
    return found


def _clean(shared, at: int):
    """The rows of which no item of the block is in the text."""

    def run(batches: Iterator[pa.RecordBatch]):
        block = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                stays = np.ones(batch.num_rows, bool)
                for row, _, _ in block.find(batch.column(at)):
                    stays[row] = False
                yield batch.filter(pa.array(stays))

    return run


def drop_leaking(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.6, block_words: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item. Rows are judged and dropped in one scan, block after block."""
    spark = common.importable(docs.sparkSession)
    at = docs.columns.index("text")
    for block in blocks(benchmark, seed, coverage, block_words):
        docs = docs.mapInArrow(_clean(spark.sparkContext.broadcast(block), at), docs.schema)
    return docs
