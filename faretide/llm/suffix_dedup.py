r"""Repeated byte strings: the common-prefix interval tree over enhanced suffix arrays.

Suffixes that share their first ``window`` bytes share the minimiser of those bytes, so all of them meet in one bucket
(see ``buckets``), and every bucket range builds its own suffix array: suffixes sorted by prefix doubling, common-prefix
lengths (LCP) from the doubling ranks. A stack scan over the LCPs walks the tree of LCP intervals from the leaves up. An
interval of length ``window`` or more whose members have different bytes before them (or begin a piece) is a maximal
repeat: it cannot be extended to the left or the right without losing members. It is put out as a group with all its
occurrences, not as pairs of neighbours.

Where a child interval joins its parent, only the child's earliest member is still without a longer match before it.
That member, unless it is the parent's earliest, is what the parent's length removes. So each suffix is settled once,
however deep the tree is, and no group is walked member by member for its ancestors.

A string is compared within its piece, a run of windows with one minimiser; a repeat that goes on beyond is found piece
by piece, as overlapping groups. Pieces that are exact copies are one member; ``groups`` lists all their places.

Defined results: a null text is empty; matches never cross documents; documents shorter than a window lose nothing; a
null doc_id comes last; rows that share a doc_id are ordered by a hash of their text, and rows equal in both are
one place, so that neither removes the other; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm import arrays, buckets, common

_STEP = 7  # bytes in the first sort key: nine bits each, 0 past the end
_ARRAY = 1 << 18  # bytes in a suffix array, or one whole bucket; the work takes eighty times its bytes, twice that for long pieces


class SuffixArray:
    """The suffixes that start in the first ``n[i]`` bytes of each string, sorted, with the LCP to the one before.

    Of these ``n.sum()`` starts, string by string, ``wanted`` may tell those to keep.
    """

    def __init__(self, strings: list[bytes], n: np.ndarray, wanted: np.ndarray | None = None):
        pad = bytes(_STEP)
        data = np.frombuffer(pad.join(strings) + pad, np.uint8)
        sizes = np.array([len(s) for s in strings], np.int64)
        first = np.cumsum(sizes + _STEP) - sizes - _STEP
        self.first, total = first, len(data)
        end = np.repeat((first + sizes).astype(np.int32), sizes + _STEP)
        symbol = data.astype(np.uint16) + np.uint16(1)
        symbol[np.arange(total, dtype=np.int32) >= end] = 0
        key = np.zeros(total, np.int64)
        for j in range(_STEP):
            key <<= 9
            key[: total - j] |= symbol[j:]
        # Only suffixes that start a window are wanted, but ranks of all positions carry the doubling.
        position = np.argsort(key).astype(np.int32)
        key = key[position]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        del key
        counts = np.diff(np.r_[head, total])
        rank = np.empty(total, np.int32)
        rank[position] = np.repeat(head.astype(np.int32), counts)
        levels = [rank]
        reach = _STEP
        open_ = position[np.repeat(counts > 1, counts)]
        del position
        longest = int(sizes.max()) if len(sizes) else 0
        while reach < longest:
            # Equal ranks whose strings end within the reach are equal for good.
            open_ = np.sort(open_[end[open_] - open_ >= reach])
            if not len(open_):
                break
            rank = levels[-1].copy()
            old, following = rank[open_], rank[np.minimum(open_ + np.int32(reach), end[open_])]
            both = (old.astype(np.int64) << 32) | following
            order = np.argsort(both)
            position, both = open_[order], both[order]
            old = (both >> 32).astype(np.int32)
            head_of_group = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            head_of_part = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
            del both, order, following
            counts = np.diff(np.r_[head_of_part, len(old)])
            moved = head_of_part - head_of_group[np.searchsorted(head_of_group, head_of_part, side="right") - 1]
            rank[position] = old + np.repeat(moved.astype(np.int32), counts)
            levels.append(rank)
            open_ = position[np.repeat(counts > 1, counts)]
            reach *= 2
        starts = np.repeat(first, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
        string = np.repeat(np.arange(len(strings)), n)
        if wanted is not None:
            starts, string = starts[wanted], string[wanted]
        order = np.argsort(levels[-1][starts], kind="stable")
        self.at, self.string = starts[order], string[order]
        a, b = self.at[:-1].copy(), self.at[1:].copy()
        lcp = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero((levels[k][a] == levels[k][b]) & (symbol[a] > 0))
            lcp[same] += _STEP << k
            a[same] = np.minimum(a[same] + (_STEP << k), end[a[same]])
            b[same] = np.minimum(b[same] + (_STEP << k), end[b[same]])
        for _ in range(_STEP):  # what is left is shorter than the first key
            more = (symbol[a] == symbol[b]) & (symbol[a] > 0)
            lcp += more
            a += more
            b += more
        # Ranks also agree where both strings end within the step.
        self.lcp = np.r_[0, np.minimum(lcp, np.minimum(end[self.at[1:]] - self.at[1:], end[self.at[:-1]] - self.at[:-1]))] if len(order) else np.zeros(0, np.int64)
        inner = self.at > first[self.string] if len(order) else np.zeros(0, bool)
        self.before = np.where(inner, data[np.maximum(self.at - 1, 0)].astype(np.int64), -1 - self.string)

    def runs(self, least: int) -> Iterator[tuple[int, int]]:
        """[from, to) of neighbours with ``least`` bytes or more in common, whose bytes before differ.

        Where all have one byte before them, the same members one byte to the left hold it.
        """
        deep = self.lcp >= least
        edge = np.flatnonzero(np.diff(np.r_[False, deep, False].astype(np.int8)))
        low, high = edge[::2] - 1, edge[1::2]
        changes = np.cumsum(np.r_[0, self.before[1:] != self.before[:-1]])
        mixed = changes[high - 1] > changes[low]
        yield from zip(low[mixed].tolist(), high[mixed].tolist())


def intervals(lcp: list[int], before: list[int], place: list[int], least: int):
    """The LCP-interval tree of one run, from the leaves up.

    Yields (length, from, to, losers) of each interval whose members differ in the byte before them; losers: its
    children's earliest members other than its own earliest.
    """
    # An open interval: length, from, the byte before (None: they differ), earliest place and its member, its losers.
    stack: list[list] = []
    n = len(place)
    for i in range(n):
        leaf = [None, i, before[i], place[i], i, []]
        height = lcp[i + 1] if i + 1 < n else 0
        node = leaf
        while stack and stack[-1][0] > height:
            node = _join(stack.pop(), node)
            if node[2] is None:
                yield node[0], node[1], i + 1, node[5]
        if i + 1 == n and height < least:
            if not stack:
                return
        if stack and stack[-1][0] == height:
            _join(stack[-1], node)
        else:
            stack.append([height, node[1], node[2], node[3], node[4], []])


def _join(parent: list, child: list) -> list:
    if child[3] < parent[3]:
        parent[5].append(parent[4])
        parent[3], parent[4] = child[3], child[4]
    elif child[3] > parent[3]:
        parent[5].append(child[4])
    if parent[2] != child[2]:
        parent[2] = None
    return parent


def joined(starts: list[int], size: int) -> list[dict]:
    """The spans that strings of ``size`` from these sorted starts cover together."""
    spans: list[dict] = []
    for at in starts:
        if spans and at <= spans[-1]["start"] + spans[-1]["size"]:
            spans[-1]["size"] = at + size - spans[-1]["start"]
        else:
            spans.append({"start": at, "size": size})
    return spans


def _pack(window: int):
    """One place of each contested piece with its bytes; of hot ones each different window by hash, equal ones together.

    Rows go out as soon as ``buckets.ROWS`` pieces and windows are held, so that a task holds no more, whatever its batches.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        out: dict[str, list] = {k: [] for k in PACKED.names}
        windows: dict[bytes, dict] = {}
        held = 0

        def put(*row):
            for name, value in zip(out, row):
                out[name].append(value)

        def packed() -> pa.RecordBatch:
            for digest, places in windows.items():
                members = []
                for place, starts in places.items():
                    starts = sorted(set(starts))
                    spans, rest = joined(starts, window), joined(starts[1:], window)
                    members.append({"_id": place[0], "_text_hash": place[1], "start": starts[0], "spans": spans, "rest": rest})
                first = min((m["_id"], m["_text_hash"], m["start"]) for m in members)
                count = sum(len(x) for x in places.values())
                put(*first, count, *np.frombuffer(digest, np.int64).tolist(), None, members)
            rows = pa.RecordBatch.from_pydict(out, schema=PACKED)
            windows.clear()
            for values in out.values():
                values.clear()
            return rows

        for batch in batches:
            columns = (batch.column(c) for c in ("_id", "_text_hash", "text", "items"))
            for doc_id, text_hash, text, pieces in zip(*columns):
                place, data = (doc_id.as_py(), text_hash.as_py()), text.as_py().encode()
                for item in pieces:
                    item = item.as_py()
                    begin, n = item["start"], item["n"]
                    if not item["hot"]:
                        put(*place, begin, n, item["mini"], None, data[begin : begin + n + window - 1], None)
                        held += 1
                    else:
                        for at in range(begin, begin + n):
                            digest = hashlib.blake2b(data[at : at + window], digest_size=16).digest()
                            windows.setdefault(digest, {}).setdefault(place, []).append(at)
                        held += n
                    if held >= buckets.ROWS:
                        yield packed()
                        held = 0
        if held:
            yield packed()

    return run


SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
MEMBERS = pa.list_(
    pa.struct([(c, pa.int64()) for c in buckets.PLACE] + [("spans", SPAN_LIST), ("rest", SPAN_LIST)])
)
PACKED = pa.schema(
    [(k, pa.int64()) for k in ("_id", "_text_hash", "start", "n", "hash_1", "hash_2")]
    + [("packed", pa.binary()), ("members", MEMBERS)]
)
PACKED_SQL = (
    "_id long, _text_hash long, start long, n long, hash_1 long, hash_2 long, packed binary, "
    "members array<struct<_id:bigint,_text_hash:bigint,start:bigint,spans:array<struct<start:bigint,size:bigint>>,"
    "rest:array<struct<start:bigint,size:bigint>>>>"
)
SPANS = "_id long, _text_hash long, start long, size long"
GROUPS = f"array string, rank long, {SPANS.rpartition(',')[0]}, piece_start long, groups array<struct<length:bigint,last:bigint>>"


def repeated(data: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Whether the window at each of ``starts`` has the hash of another one's: true of all that are equal."""
    size = 1 << (window.bit_length() - 1)  # two grams cover a window
    gram = arrays.grams(arrays.BYTE_HASH[data], size)
    hashes = gram[starts] * arrays.U(3) + gram[starts + window - size]
    del gram
    order = np.argsort(hashes)
    hashes = hashes[order]
    same = hashes[1:] == hashes[:-1]
    out = np.zeros(len(starts), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _parts(table: pa.Table, key: str, least_bytes: int) -> Iterator[pa.Table]:
    """Slices of a table that is sorted by ``key`` with ``least_bytes`` of ``packed`` or somewhat more, which part no key."""
    keys = table.column(key).to_numpy()
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = pc.binary_length(table.column("packed")).to_numpy().astype(np.int64)
    before = (np.cumsum(sizes) - sizes)[head] // least_bytes
    cut = [*head[np.flatnonzero(np.r_[True, before[1:] != before[:-1]])].tolist(), len(keys)]
    for low, high in zip(cut, cut[1:]):
        yield table.slice(low, high - low).combine_chunks()


def _scan(window: int, least_bytes: int, groups_too: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        tables = arrays.whole_keys(batches, "hash_1", least_bytes)
        for table in (part for whole in tables for part in _parts(whole, "hash_1", _ARRAY)):
            # A window that stands once is in no repeat, and a piece of such windows needs no place in the array.
            n = table.column("n").to_numpy()
            data, bounds = arrays.text_bytes(table.column("packed").combine_chunks())
            begin = np.cumsum(n) - n
            wanted = repeated(data, np.repeat(bounds[:-1] - begin, n) + np.arange(int(n.sum())), window)
            if groups_too:
                wanted[begin[table.column("copied").to_numpy()]] = True
            held = np.logical_or.reduceat(wanted, begin)
            if not held.any():
                continue
            wanted, table = wanted[np.repeat(held, n)], table.filter(pa.array(held))
            ids, hashes, starts, n = (table.column(c).to_numpy() for c in ("_id", "_text_hash", "start", "n"))
            document = np.empty(len(ids), np.int64)
            order = np.lexsort((hashes, ids))
            document[order] = arrays.groups(ids[order], hashes[order])
            array = SuffixArray(table.column("packed").to_pylist(), n, wanted)
            start = starts[array.string] + array.at - array.first[array.string]
            place = document[array.string] * (int(starts.max(initial=0) + n.max(initial=0)) + 1) + start
            rows, found, begun, inside = [], [], {}, np.zeros(len(place), bool)
            for low, high in array.runs(window):
                before = array.before[low:high].tolist()
                lcp = array.lcp[low:high].tolist()
                opened: dict[int, list] = {}
                for length, first, last, losers in intervals(lcp, before, place[low:high].tolist(), window):
                    if groups_too:
                        opened.setdefault(first, []).append({"length": length, "last": low + last - 1})
                    else:
                        rows.extend(low + x for x in losers)
                        found.extend([length] * len(losers))
                if opened:
                    inside[low:high] = True
                    begun.update((low + x, found_here) for x, found_here in opened.items())
            if groups_too:
                # A copied piece is a repeat itself, unless an interval of its length holds it with others.
                whole = (n + window - 1)[array.string]
                least = np.maximum(array.lcp, np.r_[array.lcp[1:], 0])
                copied = table.column("copied").to_numpy(zero_copy_only=False)[array.string]
                for rank in np.flatnonzero(copied & (array.at == array.first[array.string]) & (least < whole)).tolist():
                    inside[rank] = True
                    begun.setdefault(rank, []).append({"length": int(whole[rank]), "last": rank})
                rows = np.flatnonzero(inside).tolist()
                found = [begun.get(x, []) for x in rows]
            if not rows:
                continue
            take = np.array(rows)
            string = array.string[take]
            columns = [pa.array(ids[string]), pa.array(hashes[string]), pa.array(start[take])]
            names = ["_id", "_text_hash", "start"]
            if groups_too:
                name = uuid.uuid4().hex
                columns = [pa.array([name] * len(take)), pa.array(take), *columns, pa.array(starts[string]), pa.array(found, GROUP_LIST)]
                names = ["array", "rank", *names, "piece_start", "groups"]
            else:
                columns, names = [*columns, pa.array(found, pa.int64())], [*names, "size"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


GROUP_LIST = pa.list_(pa.struct([("length", pa.int64()), ("last", pa.int64())]))


class Repeats:
    """The pieces of ``docs`` and what repeats in them; ``window`` bytes at least."""

    def __init__(self, docs: DataFrame, window: int = 100, gram: int = 32, hot: int = 2048, bucket_bytes: int = 2 << 20):
        self.window, self.bucket_bytes = window, bucket_bytes
        self.found = common.saved(buckets.candidates(docs, buckets.byte_units, window, gram))
        self.unique = common.saved(buckets.distinct(self.found))
        self.wanted = buckets.contested(self.unique, hot).select("first.*", "mini", "piece", "n", "hot")
        lists = buckets.with_lists(docs, self.wanted, ["mini", "piece", "start", "n", "hot"], "inner")
        rows = lists.select("_id", "_text_hash", "text", "items").mapInArrow(_pack(window), PACKED_SQL)
        self.packed = common.saved(rows)
        cold = self.packed.where("packed IS NOT NULL").drop("members")
        self.cold = cold.repartition("hash_1").sortWithinPartitions("hash_1")

    def groups(self) -> DataFrame:
        """Maximal repeats: a row for each occurrence of each member suffix, by its rank in its suffix array.

        ``groups`` lists the repeats that begin at this rank: their length, and the rank of their last member. All
        occurrences of a repeat are the rows of that ``array`` from the one rank to the other, so that nested repeats
        do not list their members again; exact copies have the same rank. Copied pieces outside the suffix arrays, and
        the repeated windows of hot buckets, are an ``array`` each, of rank 0; those windows are not joined to longer repeats.
        """
        first = [F.col(f"first.{c}").alias(f"of{c}" if c[0] == "_" else f"of_{c}") for c in buckets.PLACE]
        of = ["of_id", "of_text_hash", "of_start"]
        shared = self.unique.where("places > 1").select("mini", "piece", "first")
        later = common.apart(self.found, ["mini", "piece"], "key").join(common.apart(shared, ["mini", "piece"], "key").select("key", "piece", "first"), ["key", "piece"])
        later = later.where(F.struct(*buckets.PLACE) > F.col("first"))
        later = common.saved(later.select("mini", "piece", "n", *first, *buckets.PLACE).distinct())
        copied = later.select("mini", "piece", "n", *of).distinct()

        # In suffix arrays: members, and the copies of their pieces.
        cold = self.packed.where("packed IS NOT NULL").drop("members").withColumnsRenamed(dict(zip(buckets.PLACE, of)))
        cold = cold.join(copied.select(*of, F.lit(True).alias("copied")), of, "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
        cold = cold.withColumnsRenamed(dict(zip(of, buckets.PLACE))).repartition("hash_1").sortWithinPartitions("hash_1")
        members = common.saved(cold.mapInArrow(_scan(self.window, self.bucket_bytes, True), GROUPS))
        names = ["array", "rank", *buckets.PLACE, "groups"]
        moved = members.withColumnsRenamed({"_id": "of_id", "_text_hash": "of_text_hash", "piece_start": "of_start", "start": "at"})
        moved = moved.join(later.drop("mini", "piece", "n"), of).withColumn("start", F.col("start") + F.col("at") - F.col("of_start"))
        found = members.select(*names).unionByName(moved.withColumn("groups", F.slice("groups", 1, 0)).select(*names))

        # Copied pieces that have no rival, or stand in a hot bucket.
        group = lambda length: F.array(F.struct(length.cast("long").alias("length"), F.lit(0).cast("long").alias("last"))).alias("groups")
        apart = copied.join(self.wanted.where("NOT hot").select("mini", "piece"), ["mini", "piece"], "left_anti")
        places = apart.select("mini", "piece", "n", *(F.col(o).alias(c) for o, c in zip(of, buckets.PLACE)))
        places = places.unionByName(later.join(apart.select("mini", "piece"), ["mini", "piece"]).select(*places.columns))
        name = F.concat(F.lit("piece-"), F.hex("mini"), F.lit("-"), F.hex("piece")).alias("array")
        found = found.unionByName(places.select(name, F.lit(0).cast("long").alias("rank"), *buckets.PLACE, group(F.col("n") + self.window - 1)))

        # Windows of hot buckets, in the first place of their piece and in its copies.
        windows = self.packed.where("members IS NOT NULL").select("hash_1", "hash_2", F.explode("members").alias("m"))
        windows = windows.select("hash_1", "hash_2", "m._id", "m._text_hash", F.explode("m.spans").alias("s"))
        last = F.col("s.start") + F.col("s.size") - self.window
        windows = windows.select("hash_1", "hash_2", "_id", "_text_hash", F.explode(F.sequence("s.start", last)).alias("start"))
        cut = later.join(self.wanted.where("hot").select("mini", "piece"), ["mini", "piece"])
        cut = cut.select(F.col("n"), *of, F.col("_id").alias("to_id"), F.col("_text_hash").alias("to_hash"), F.col("start").alias("to_start"))
        held = (F.col("_id") == F.col("of_id")) & (F.col("_text_hash") == F.col("of_text_hash"))
        held &= (F.col("start") >= F.col("of_start")) & (F.col("start") < F.col("of_start") + F.col("n"))
        again = windows.join(cut, held).withColumn("start", F.col("start") - F.col("of_start") + F.col("to_start"))
        again = again.select("hash_1", "hash_2", F.col("to_id").alias("_id"), F.col("to_hash").alias("_text_hash"), "start")
        windows = common.saved(windows.unionByName(again).distinct())
        repeated = windows.groupBy("hash_1", "hash_2").count().where("count > 1").drop("count")
        windows = common.apart(windows, ["hash_1", "hash_2"], "key").join(common.apart(repeated, ["hash_1", "hash_2"], "key").drop("hash_1"), ["key", "hash_2"])
        name = F.concat(F.lit("window-"), F.hex("hash_1"), F.lit("-"), F.hex("hash_2")).alias("array")
        return found.unionByName(windows.select(name, F.lit(0).cast("long").alias("rank"), *buckets.PLACE, group(F.lit(self.window))))

    def copies(self) -> DataFrame:
        """(_id, _text_hash, start, n): places of pieces that occur exactly so at an earlier place."""
        shared = self.unique.where("places > 1").select("mini", "piece", "first")
        later = self.found.join(shared, ["mini", "piece"]).where(F.struct(*buckets.PLACE) > F.col("first"))
        return later.select(*buckets.PLACE, "n")

    def later_spans(self) -> DataFrame:
        """(_id, _text_hash, spans): bytes that a string of ``window`` bytes covers which also starts earlier."""
        size = (F.col("n") + self.window - 1).alias("size")
        whole = self.copies().select(*buckets.PLACE, size)
        tree = self.cold.mapInArrow(_scan(self.window, self.bucket_bytes, False), SPANS)
        hashes, place = ["hash_1", "hash_2"], F.struct(*buckets.PLACE)
        windows = self.packed.where("members IS NOT NULL")
        first = windows.groupBy(*hashes).agg(F.min(place).alias("first"), F.sum("n").alias("c"))
        first = common.apart(first.where("c > 1"), hashes, "key").select("key", "hash_2", "first")
        again = common.apart(windows, hashes, "key").join(first, ["key", "hash_2"])
        later = F.transform(
            "members",
            lambda m: F.struct(
                m["_id"].alias("_id"),
                m["_text_hash"].alias("_text_hash"),
                F.when(F.struct(m["_id"], m["_text_hash"], m["start"]) > F.col("first"), m["spans"])
                .otherwise(m["rest"])
                .alias("spans"),
            ),
        )
        later = F.filter(later, lambda m: F.size(m["spans"]) > 0)
        single = again.select(F.explode(later).alias("m")).select("m.*")
        whole = whole.unionByName(tree).select("_id", "_text_hash", F.array(F.struct("start", "size")).alias("spans"))
        return whole.unionByName(single)


def _remove(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, sizes, removed, spans, kept = [], [], [], [], []
            for doc_id, text, items in zip(batch.column("doc_id"), batch.column("text"), batch.column("items")):
                data, runs = text.as_py().encode(), items.as_py()
                total, n_runs = len(data), 0
                if runs:
                    runs.sort(key=lambda r: r["start"])
                    parts, at = [], 0
                    for r in runs:
                        low, high = r["start"], r["start"] + r["size"]
                        if low > at or n_runs == 0:
                            n_runs += 1
                            parts.append(data[at:low])
                        at = max(at, high)
                    data = b"".join([*parts, data[at:]])
                ids.append(doc_id.as_py())
                sizes.append(total)
                removed.append(total - len(data))
                spans.append(n_runs)
                kept.append(data if keep_text else hashlib.sha256(data).hexdigest())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if keep_text else "kept_sha256"]
            longs = [pa.array(x, pa.int64()) for x in (ids, sizes, removed, spans)]
            yield pa.RecordBatch.from_arrays([*longs, pa.array(kept, pa.binary() if keep_text else pa.string())], names=names)

    return run


def dedup_bytes(docs: DataFrame, window: int = 100, keep_text: bool = True, **how) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, and the bytes left (``kept``) or their digest (``kept_sha256``)."""
    spans = Repeats(docs, window, **how).later_spans()
    rows = buckets.with_lists(docs, spans, ["spans"], "left").select("doc_id", "text", F.expr("flatten(items.spans)").alias("items"))
    last = "kept binary" if keep_text else "kept_sha256 string"
    return rows.mapInArrow(_remove(keep_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
