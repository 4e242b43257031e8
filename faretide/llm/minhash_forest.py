r"""Near duplicates: an LSH forest of MinHash signatures.

A document's set is its distinct runs of ``size`` words. Documents with the same set are one class and are linked at
once. Each class has ``trees * depth`` MinHash values; tree t orders the classes by the values from ``t * depth`` on,
round the signature. Classes whose longest common prefix in a tree's order is ``depth`` values or more are neighbours in a
region. A region of ``region`` members or fewer proposes its members to one another. A larger one is cut deeper, by
twice as many values, so that the depth follows how crowded the region is; its members also meet the region's
first member, so that cutting does not part a large family. Members with equal values to the last depth meet that
first member alone.

Candidates are confirmed on full sets, in two rounds: first each class with its best candidate, then only candidates
that these links have not joined already, as others cannot change a component. Links are exact: 100 * shared >=
75 * union.

Cutting may still part a pair, such as a base and a copy of it where the region's first member is neither. So the
regions above ``region`` at the least depth are dealt again: where one holds several components, every member outside its
largest is compared on full sets with every member of another component, in blocks of ``block`` members. So all pairs of
a region are proposed or compared, however crowded it is: a pair at the limit of 0.75 is missed by all 32 trees of depth
4 with a chance of five in a million, and no other pair is missed more often.

Sets are sets of 64-bit hashes of the words' bytes. Defined results: a null, empty or blank text has an empty set and
no links; rows are told apart by id and text and linked only where they are alike, whatever ids they share or lack; an id
names the component, where a null id comes last and is shown as null; repeated rows are one node; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays, buckets, common
from faretide.llm.components import components

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEY = ["_id", "_text_hash"]


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    data, bounds = arrays.text_bytes(column)
    data = LOWER[data]
    starts, ends, first = arrays.word_spans(data, bounds)
    words = arrays.word_hashes(data, starts, ends)
    runs = words[: max(0, len(words) - size + 1)].copy()
    for j in range(1, size):
        runs = runs * U(arrays._BASE) + words[j : j + len(runs)]
    runs = arrays.mix(runs)
    short = arrays.Ranges(words)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            yield np.unique(runs[low : high - size + 1])
        elif high > low:
            yield short.of(np.array([low]), np.array([high]))
        else:
            yield runs[:0]


def _sign(size: int, values: int):
    factors = arrays.mix(np.arange(1, values + 1, dtype=U) * U(arrays._BASE)) | U(1)

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = list(shingle_sets(batch.column("text"), size))
                sizes = np.array([len(s) for s in sets])
                joined = np.concatenate(sets)
                filled = np.flatnonzero(sizes)
                begin = (np.cumsum(sizes) - sizes)[filled]
                signature = np.zeros((len(sets), values), np.uint32)
                sums = np.zeros((2, len(sets)), U)
                if len(filled):
                    for k in range(values):
                        signature[filled, k] = np.minimum.reduceat(joined * factors[k], begin) >> U(32)
                    sums[0, filled] = np.add.reduceat(joined, begin)
                    sums[1, filled] = np.add.reduceat(arrays.mix(joined * U(3)), begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("_id"), batch.column("_text_hash"), pa.array(sizes, pa.int64()),
                        pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                    ],
                    names=["doc_id", "_id", "_text_hash", "n_shingles", "set_1", "set_2", "signature"],
                )

    return run


def _order_keys(values: np.ndarray, tree: np.ndarray, depth: int, used: int) -> np.ndarray:
    """For each row of signature values: the hash of the first ``used`` of its tree's order, which begins at tree * depth."""
    state = tree.astype(U) + U(1)
    for k in range(used):
        at = (tree * depth + k) % values.shape[1]
        state = arrays.mix(state * U(arrays._BASE) + values[np.arange(len(values)), at])
    return state.view(np.int64)


def _orders(trees: int, depth: int):
    """A row for each tree of each class, with the key of its region at the least depth."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            values = _values(batch)
            for t in range(trees):
                tree = np.full(len(values), t)
                own = [pa.array(tree), pa.array(_order_keys(values, tree, depth, depth))]
                yield pa.RecordBatch.from_arrays([*own, *(batch.column(c) for c in (*KEY, "n_shingles"))], names=ROW)

    return run


def _deeper(depth: int, used: int):
    """The same rows with the key of a deeper region."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            tree = batch.column("tree").to_numpy()
            key = pa.array(_order_keys(_values(batch), tree, depth, used))
            yield pa.RecordBatch.from_arrays([batch.column("tree"), key, *(batch.column(c) for c in (*KEY, "n_shingles"))], names=ROW)

    return run


def _values(batch: pa.RecordBatch) -> np.ndarray:
    joined = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).astype(U)
    return joined.reshape(batch.num_rows, -1) if batch.num_rows else joined.reshape(0, 1)


ROW = ["tree", "key", *KEY, "n_shingles"]
ROW_SQL = "tree long, key long, _id long, _text_hash long, n_shingles long"


def _neighbours(region: int, share: int):
    """Pairs of sorted neighbours of each region that could be alike by their sizes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for table in arrays.whole_keys(batches, "key", 1 << 20):
            key, sizes = table.column("key").to_numpy(), table.column("n_shingles").to_numpy()
            left, right = [], []
            for step in range(1, region):
                a = np.flatnonzero(key[step:] == key[:-step])
                if not len(a):
                    break
                b = a + step
                near = 100 * np.minimum(sizes[a], sizes[b]) >= share * np.maximum(sizes[a], sizes[b])
                left.append(a[near])
                right.append(b[near])
            if not left:
                continue
            a, b = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
            ids, hashes = table.column("_id").combine_chunks(), table.column("_text_hash").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(a), hashes.take(a), ids.take(b), hashes.take(b)], names=["a_id", "a_hash", "b_id", "b_hash"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_text_hash"), pa.array(sets, pa.binary())], names=[*KEY, "members"])

    return run


def _confirm(share: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            alike = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = np.frombuffer(a.as_py(), U), np.frombuffer(b.as_py(), U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * both >= share * (len(x) + len(y) - both))
            yield batch.select(["a_id", "a_hash", "b_id", "b_hash"]).filter(pa.array(alike, pa.bool_()))

    return run


def _shared(row: np.ndarray, column: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns each row of ``a`` and each of ``b`` have both; (row, column) are the entries."""
    n = int(column.max(initial=-1)) + 1
    sides = []
    for rows in (a, b):
        place = np.full(int(row.max(initial=-1)) + 1, -1)
        place[rows] = np.arange(len(rows))
        own = place[row] >= 0
        sides.append((place[row[own]], column[own]))
    held = [np.bincount(c, minlength=n) for _, c in sides]
    pairs = held[0] * held[1]
    # Columns that many hold are multiplied as matrices, and come first; the others' pairs are counted one by one.
    dense = 32 * pairs >= len(a) * len(b)
    order = np.argsort(~dense, kind="stable")
    number = np.empty(n, np.int64)
    number[order] = np.arange(n)
    (row_a, col_a), (row_b, col_b) = ((r[o := np.argsort(number[c], kind="stable")], number[c][o]) for r, c in sides)
    both, n_dense = np.zeros((len(a), len(b)), np.int64), int(dense.sum())
    for low in range(0, n_dense, 1024):
        high = min(low + 1024, n_dense)
        parts = []
        for r, c, size in ((row_a, col_a, len(a)), (row_b, col_b, len(b))):
            part = slice(*np.searchsorted(c, [low, high]))
            parts.append(np.zeros((size, high - low), np.float32))
            parts[-1][r[part], c[part] - low] = 1
        both += (parts[0] @ parts[1].T).astype(np.int64)
    at = int(np.searchsorted(col_a, n_dense))
    row_a, col_a = row_a[at:], col_a[at:]
    many, begin = held[1][order[col_a]], np.searchsorted(col_b, col_a)
    ends = np.cumsum(many)
    low = 0
    while low < len(many):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + (1 << 22))))
        k = many[low:high]
        place = np.repeat(begin[low:high] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        both += np.bincount(np.repeat(row_a[low:high], k) * len(b) + row_b[place], minlength=both.size).reshape(both.shape)
        low = high
    return both


def _joining(pairs: np.ndarray) -> list[int]:
    """Which of the pairs of numbers join what those before them have not."""
    parent: dict[int, int] = {}
    out = []
    for k, ends in enumerate(pairs.tolist()):
        roots = []
        for x in ends:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            roots.append(x)
        if roots[0] != roots[1]:
            parent[max(roots)] = min(roots)
            out.append(k)
    return out


def _across(share: int):
    """Links between the components of a block: as many as join them."""

    def run(batches: Iterator[pa.RecordBatch]):
        for table in arrays.whole_keys(batches, "block", 1 << 22):
            block = table.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part = table.slice(low, high - low)
                sets = [np.frombuffer(x, U) for x in part.column("members").to_pylist()]
                sizes = np.array([len(x) for x in sets])
                ids, hashes, side, of_id, of_hash = (part.column(c).to_numpy() for c in (*KEY, "side", "of_id", "of_hash"))
                order = np.lexsort((of_hash, of_id))
                of = np.empty(len(order), np.int64)
                of[order] = arrays.groups(of_id[order], of_hash[order])
                a = np.flatnonzero(side == 0)
                b = np.flatnonzero(side == 1) if side.any() else a
                column = np.unique(np.concatenate(sets), return_inverse=True)[1]
                both = _shared(np.repeat(np.arange(len(sets)), sizes), column, a, b)
                alike = 100 * both >= share * (sizes[a][:, None] + sizes[b][None, :] - both)
                x, y = np.nonzero(alike & (of[a][:, None] != of[b][None, :]))
                x, y = a[x], b[y]
                least = np.unique(np.sort(np.stack([of[x], of[y]], 1), 1), axis=0, return_index=True)[1]
                x, y = x[least], y[least]
                keep = _joining(np.stack([of[x], of[y]], 1))
                columns = [pa.array(v) for v in (ids[x[keep]], hashes[x[keep]], ids[y[keep]], hashes[y[keep]])]
                yield pa.RecordBatch.from_arrays(columns, names=["a_id", "a_hash", "b_id", "b_hash"])

    return run


PAIR = "a_id long, a_hash long, b_id long, b_hash long"


def _ends(pairs: DataFrame) -> DataFrame:
    """The links (u, v) between the nodes of ``pairs``."""
    sides = (("a", "u"), ("b", "v"))
    return pairs.select(*(F.struct(F.col(f"{s}_id").alias("_id"), F.col(f"{s}_hash").alias("_text_hash")).alias(end) for s, end in sides))


class Forest:
    """The classes, candidates and confirmed links of ``docs``. A node is the _id and _text_hash of a class's first row."""

    def __init__(self, docs: DataFrame, size: int = 5, share: int = 75, trees: int = 32, depth: int = 4, region: int = 24, levels: int = 4, block: int = 256):
        self.docs, self.size, self.share, self.region, self.block = docs, size, share, region, block
        self.trees, self.depth, self.levels, self.values = trees, depth, levels, trees * depth
        keyed = common.keyed(docs).select("doc_id", *KEY, "text")
        schema = "doc_id long, _id long, _text_hash long, n_shingles long, set_1 long, set_2 long, signature binary"
        self.signed = common.saved(keyed.mapInArrow(_sign(size, trees * depth), schema))
        first = F.min(F.struct(*KEY, "n_shingles", "signature")).alias("first")
        filled = self.signed.where("n_shingles > 0")
        self.classes = common.saved(filled.groupBy("set_1", "set_2").agg(first).select("set_1", "set_2", "first.*"))
        rows = self.classes.select(*KEY, "n_shingles", "signature").mapInArrow(_orders(trees, depth), ROW_SQL)
        shared = rows.groupBy("key").count().where("count > 1").select("key")
        self.rows = common.saved(common.in_both(rows, shared, "key"))

    def candidates(self) -> DataFrame:
        """(a_id, a_hash, b_id, b_hash, trees): proposed pairs and how often they were proposed."""
        parts, regions, rows = [], [], self.rows
        for level in range(self.levels):
            counts = rows.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct(*KEY, "n_shingles")).alias("hub"))
            counts = counts.where("c > 1").withColumn("salted", F.xxhash64("key"))
            told = common.saved(rows.withColumn("salted", F.xxhash64("key")).join(counts, ["salted", "key"]).drop("salted"))
            regions.append(told.where(F.col("c") <= self.region).select("key", *KEY, "n_shingles"))
            big = told.where(F.col("c") > self.region)
            if level == 0:
                self.crowded = big.select("tree", "key", *KEY, "n_shingles")
            near = F.least("n_shingles", "hub.n_shingles") * 100 >= F.greatest("n_shingles", "hub.n_shingles") * self.share
            others = big.where(near & (F.struct(*KEY) != F.struct("hub._id", "hub._text_hash")))
            hub = [F.col("hub._id").alias("a_id"), F.col("hub._text_hash").alias("a_hash")]
            parts.append(others.select(*hub, F.col("_id").alias("b_id"), F.col("_text_hash").alias("b_hash")))
            used = min(self.values, self.depth << (level + 1))
            rest = big.select("tree", *KEY, "n_shingles")
            if level + 1 == self.levels or rest.isEmpty():
                break
            rest = rest.join(self.classes.select(*KEY, "signature"), KEY)
            rows = common.saved(rest.mapInArrow(_deeper(self.depth, used), ROW_SQL))
        # A region's key is a hash of its tree, depth and values, so those of all levels can be dealt out together.
        small = reduce(DataFrame.unionByName, regions).repartition("key").sortWithinPartitions("key", *KEY)
        parts.append(small.mapInArrow(_neighbours(self.region, self.share), PAIR))
        pairs = reduce(DataFrame.unionByName, parts)
        a, b = F.struct(F.col("a_id").alias("i"), F.col("a_hash").alias("h")), F.struct(F.col("b_id").alias("i"), F.col("b_hash").alias("h"))
        low, high = F.least(a, b), F.greatest(a, b)
        pairs = pairs.select(low["i"].alias("a_id"), low["h"].alias("a_hash"), high["i"].alias("b_id"), high["h"].alias("b_hash"))
        return pairs.groupBy("a_id", "a_hash", "b_id", "b_hash").agg(F.count("*").alias("trees"))

    def _confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            own = sets.select(F.col("_id").alias(f"{side}_id"), F.col("_text_hash").alias(f"{side}_hash"), F.col("members").alias(f"{side}_set"))
            pairs = pairs.join(own, [f"{side}_id", f"{side}_hash"])
        return _ends(pairs.select("a_id", "a_hash", "b_id", "b_hash", "a_set", "b_set").mapInArrow(_confirm(self.share), PAIR))

    def _blocks(self, rows: DataFrame, linked: DataFrame) -> DataFrame:
        """(block, side, _id, _text_hash, of_id, of_hash): what to compare of the crowded ``rows``.

        Members outside their region's largest component are compared with all, those inside only with the others.
        """
        named = linked.select("node._id", "node._text_hash", "component")
        rows = rows.join(named, KEY, "left").withColumn("of", F.coalesce("component", F.struct(*KEY))).drop("component")
        rows = common.saved(rows.withColumn("salted", F.xxhash64("key")))
        parts = rows.groupBy("key", "of").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("n"))
        regions = parts.groupBy("key").agg(F.max(F.struct("c", "of", "n")).alias("top"), F.sum("c").alias("c"), F.sum("n").alias("n"))
        size = lambda c, n: F.ceil(F.greatest(c / F.lit(self.block), n / F.lit(self.block << 12)))
        others = size(F.col("c") - F.col("top.c"), F.col("n") - F.col("top.n"))
        regions = regions.where("c > top.c").select("key", F.xxhash64("key").alias("salted"), F.col("top.of").alias("top"), others.alias("others"), size(F.col("top.c"), F.col("top.n")).alias("largest"))
        dealt = rows.join(regions, ["salted", "key"])
        own, inside = F.xxhash64(*KEY, F.lit(1)), F.col("of") == F.col("top")
        dealt = dealt.withColumn("part", F.when(inside, F.col("others") + F.pmod(own, "largest")).otherwise(F.pmod(own, "others")))
        last = F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("largest")) - 1
        dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        low, high = F.least("part", "with"), F.greatest("part", "with")
        side = (F.col("part") > F.col("with")).cast("long").alias("side")
        return dealt.select(F.xxhash64("key", low, high).alias("block"), side, *KEY, F.col("of._id").alias("of_id"), F.col("of._text_hash").alias("of_hash"))

    def _across_crowded(self, linked: DataFrame, sets: DataFrame) -> DataFrame:
        """``linked``, and joined what is alike in a crowded region but was parted when that was cut.

        A few trees first: what they join need not be compared again in the others.
        """
        if self.crowded.isEmpty():
            return linked
        for low, high in ((0, 4), (4, self.trees)):
            rows = self.crowded.where(F.col("tree").between(low, high - 1))
            blocks = common.saved(self._blocks(rows, linked))
            if blocks.isEmpty():
                continue
            dealt = blocks.join(sets, KEY).repartition("block").sortWithinPartitions("block")
            more = common.saved(_ends(dealt.mapInArrow(_across(self.share), PAIR)))
            if more.isEmpty():
                continue
            found = linked.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
            linked = common.saved(components(found))
        return linked

    def links(self) -> DataFrame:
        """(node, component) of the linked class representatives."""
        pairs = common.saved(self.candidates())
        ends = pairs.select(F.col("a_id").alias("_id"), F.col("a_hash").alias("_text_hash")).union(pairs.select("b_id", "b_hash"))
        ends = ends.union(self.crowded.select(*KEY)).distinct()
        # Merged at every size: no bound is known for the ends, and repeated rows then meet without another shuffle.
        texts = common.keyed(self.docs).select(*KEY, "text").join(ends.hint("merge"), KEY, "left_semi")
        sets = texts.dropDuplicates(KEY).mapInArrow(_sets(self.size), "_id long, _text_hash long, members binary")
        sets = common.saved(sets)
        # Round one: the candidate that most trees propose, of each class.
        sides = pairs.select(F.struct("a_id", "a_hash").alias("of"), F.struct("trees", "a_id", "a_hash", "b_id", "b_hash").alias("p"))
        sides = sides.union(pairs.select(F.struct(F.col("b_id"), F.col("b_hash")), F.struct("trees", "a_id", "a_hash", "b_id", "b_hash")))
        best = sides.groupBy("of").agg(F.max("p").alias("p")).select("p.a_id", "p.a_hash", "p.b_id", "p.b_hash").distinct()
        first = common.saved(components(self._confirmed(best, sets)))
        # Round two: what could still join two of these.
        rest = pairs.drop("trees").join(best, ["a_id", "a_hash", "b_id", "b_hash"], "left_anti")
        for side in ("a", "b"):
            own = [f"{side}_id", f"{side}_hash"]
            named = first.select(F.col("node._id").alias(own[0]), F.col("node._text_hash").alias(own[1]), F.col("component").alias(f"{side}_of"))
            alone = F.struct(F.col(own[0]).alias("_id"), F.col(own[1]).alias("_text_hash"))
            rest = rest.join(named, own, "left").withColumn(f"{side}_of", F.coalesce(f"{side}_of", alone))
        more = self._confirmed(rest.where("a_of <> b_of").drop("a_of", "b_of"), sets)
        found = first.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
        return self._across_crowded(common.saved(components(found)), sets)


def kept_rows(docs: DataFrame, **how) -> DataFrame:
    """(_id, _text_hash) of the first row of each group of alike rows that have words, each once.

    Rows are told apart by id and text: those that share an id, or have none, are linked only where they are alike.
    """
    forest = Forest(docs, **how)
    own = F.struct(*KEY)
    # The first row of a group is the first of its class, so the classes tell it.
    nodes = forest.classes.select(*KEY, own.alias("node")).join(forest.links(), "node", "left")
    return nodes.where(F.coalesce("component", "node") == F.col("node")).select(*KEY)


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    forest = Forest(docs, **how)
    first = F.struct(*KEY).alias("node")
    classes = common.apart(forest.classes, ["set_1", "set_2"], "key").select("key", "set_2", first)
    rows = common.apart(forest.signed, ["set_1", "set_2"], "key").select("doc_id", *KEY, "n_shingles", "key", "set_2")
    rows = rows.join(classes, ["key", "set_2"], "left").withColumn("node", F.coalesce("node", first))
    # A class's first row has its smallest id, and a component's smallest node the smallest of all.
    linked = forest.links()
    told = rows.join(linked, "node", "left")
    least = F.least(F.coalesce("component", "node")["_id"], F.col("_id"))
    component = F.when(F.col("n_shingles") == 0, F.col("_id")).otherwise(least)
    shown = F.when(component != common.NO_ID, component)
    return told.select("doc_id", "n_shingles", shown.alias("component_id"), (F.col("_id") == component).alias("kept"))


#: The result in SQL, for tables where all pairs that share a shingle can be listed and ids differ.
REPORT_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)
), both_ways AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT reached.doc_id, y FROM reached JOIN both_ways ON x = other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""
