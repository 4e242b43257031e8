"""Line, passage, byte and near-duplicate dedup against plain versions."""

import random

import duckdb
import pytest

from faretide.llm import buckets, components, line_dedup, minhash_forest, suffix_dedup, superkmer_dedup
from tests.llm import brute
from tests.llm.conftest import ODD


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def family(documents):
    """Documents, a family of edited copies, periodic texts and a missing id."""
    rng = random.Random(1)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").limit(120).collect()]
    base = next(t for _, t in rows if len(t) > 2500)[:2500]
    for i in range(30):
        text = list(base)
        for _ in range(rng.randrange(1, 14)):
            text[rng.randrange(len(text))] = rng.choice("abc ")
        rows.append((10_000 + i, "".join(text)))
    return [*rows, (20_000, "a b " * 200), (20_001, "z " * 300), (20_002, None), (None, "q w e " * 60), (20_003, rows[3][1])]


@pytest.mark.parametrize("hot", [1, 1024])
def test_passages(spark, family, hot):
    got = superkmer_dedup.dedup_passages(frame(spark, family), keep_text=False, hot=hot)
    assert brute.ordered(rows_of(got)) == brute.passages(family)


def test_passages_small_windows_and_odd_rows(spark):
    rows = [*ODD, (7, "one two three four five"), (8, "zero one two three four")]
    got = superkmer_dedup.dedup_passages(frame(spark, rows), window=4, gram=2, keep_text=False)
    assert brute.ordered(rows_of(got)) == brute.passages(rows, 4)


def test_passages_text(spark):
    rows = [(1, "x one two three four y"), (2, "z one two three four")]
    got = superkmer_dedup.dedup_passages(frame(spark, rows), window=4, gram=2)
    assert sorted(rows_of(got)) == [(1, 6, 4, "x y"), (2, 5, 4, "z")]


@pytest.mark.parametrize("hot", [1, 2048])
def test_bytes(spark, family, hot):
    got = suffix_dedup.dedup_bytes(frame(spark, family), keep_text=False, hot=hot)
    assert brute.ordered(rows_of(got)) == brute.byte_repeats(family)


def test_bytes_odd_rows(spark):
    rows = [r for r in ODD if r[0] != 4]
    got = suffix_dedup.dedup_bytes(frame(spark, rows), keep_text=False)
    assert brute.ordered(rows_of(got)) == brute.byte_repeats(rows)


def test_identical_rows_are_one_place(spark):
    rows = [(1, "abc" * 60), (1, "abc" * 60)]
    got = rows_of(suffix_dedup.dedup_bytes(frame(spark, rows), keep_text=False))
    assert got[0] == got[1] and got[0][1:3] == (180, 177)


def test_repeat_groups_hold_all_members(spark):
    common = "".join(random.Random(3).choice("abcdefgh") for _ in range(150))
    repeats = suffix_dedup.Repeats(frame(spark, [(i, f"{i}{common}{i * 7}") for i in range(5)]))
    rows = repeats.groups().collect()
    found = [(r.array, r.rank, g.last, g.length) for r in rows for g in r.groups]
    assert found and all(length >= 100 for *_, length in found)
    sizes = {last - first + 1 for _, first, last, _ in found}
    assert 5 in sizes


@pytest.mark.parametrize("hot", [1, 2048])
def test_repeat_groups_hold_all_places(spark, hot):
    """Also exact copies: of a document, and of a passage in the same and in other surroundings."""
    rng = random.Random(6)
    some = ["".join(rng.choice("abcdefgh") for _ in range(400)) for _ in range(5)]
    texts = {1: some[0], 2: some[0], 3: some[1], 4: "x" + some[1][50:300] + some[2], 5: some[1][:250] + "y", 6: some[1], 7: some[3] + some[4], 8: some[3]}
    rows = [*texts.items(), (1, some[0])]
    got = suffix_dedup.Repeats(frame(spark, rows), hot=hot).groups().collect()
    places, held = {}, {}
    for r in got:
        places.setdefault((r.array, r.rank), set()).add((r._id, r.start))
    for r in got:
        for g in r.groups:
            of = set().union(*(places.get((r.array, k), set()) for k in range(r.rank, g.last + 1)))
            assert len(of) > 1 and len({texts[d][at : at + g.length] for d, at in of}) == 1
            for k in range(g.length - 99):
                window = texts[r._id][r.start + k : r.start + k + 100]
                held.setdefault(window, []).append({(d, at + k) for d, at in of})
    want = {}
    for d, text in texts.items():
        for at in range(len(text) - 99):
            want.setdefault(text[at : at + 100], set()).add((d, at))
    want = {w: of for w, of in want.items() if len(of) > 1}
    assert set(held) == set(want) and all(max(held[w], key=len) == of for w, of in want.items())


@pytest.mark.parametrize("names", [("aabaabaab" * 3, "baab" * 9), ("mississippi" * 4, "ssi" * 15)])
def test_suffix_array(names):
    import numpy as np

    strings = [x.encode() for x in names]
    n = np.array([len(s) - 4 for s in strings])
    array = suffix_dedup.SuffixArray(strings, n)
    suffixes = [strings[s][int(a - array.first[s]) :] for s, a in zip(array.string, array.at)]
    assert suffixes == sorted(suffixes) and len(suffixes) == n.sum()
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert array.lcp[i] == same


@pytest.mark.parametrize("n_keys", [2000, 1])
def test_scan_memory(n_keys):
    """Many small buckets in one batch, and one large bucket: what a task holds stays near the bytes of one array."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    bases = rng.integers(97, 101, (n_keys, 168), np.uint8)
    pieces = np.repeat(bases, 10_000 // n_keys, axis=0)
    rows = np.arange(len(pieces))
    pieces[rows, rng.integers(0, 168, len(rows))] = 65 + rows % 26
    columns = {
        "_id": rows,
        "_text_hash": rows,
        "start": np.zeros_like(rows),
        "n": np.full_like(rows, 69),
        "hash_1": rows // (10_000 // n_keys),
        "hash_2": rows,
        "packed": pa.array([p.tobytes() for p in pieces], pa.binary()),
    }
    batch = pa.RecordBatch.from_pydict(columns)
    scan = suffix_dedup._scan(100, 2 << 20, False)
    tracemalloc.start()
    found = sum(out.num_rows for out in scan(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 0 and peak < (40 << 20 if n_keys > 1 else 100 * pieces.size)


def hot_batch(n_docs, size, letters):
    """Texts all of whose pieces stand in a hot bucket."""
    import pyarrow as pa

    rng = random.Random(2)
    ids = list(range(n_docs))
    texts = ["".join(rng.choices(letters, k=size)) for _ in ids]
    pieces = [{"mini": 7, "piece": k, "start": at, "n": min(60, size - 99 - at), "hot": True} for k, at in enumerate(range(0, size - 99, 60))]
    kind = pa.list_(pa.struct([("mini", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_())]))
    return pa.RecordBatch.from_pydict({"_id": ids, "_text_hash": ids, "text": texts, "items": pa.array([pieces] * n_docs, kind)})


@pytest.mark.parametrize("pack", [suffix_dedup._pack(100), superkmer_dedup._pack(35)])
def test_pack_memory(pack):
    """Many windows of hot buckets in one batch: a task does not hold them all."""
    import tracemalloc

    import pyarrow as pa

    batch = hot_batch(60, 2000, "abcd")
    if pack.__module__ == superkmer_dedup.__name__:  # a word for each byte
        items = batch.column("items")
        items = pa.array([[x | {"places": 1} for x in row] for row in items.to_pylist()], pa.list_(pa.struct([*items.type.value_type, pa.field("places", pa.int64())])))
        batch = pa.RecordBatch.from_pydict({"text": [" ".join(t) for t in batch.column("text").to_pylist()], "items": items})
    tracemalloc.start()
    found = sum(out.num_rows for out in pack(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 60 * 1800 and peak < 64 << 20


def test_packed_in_parts(monkeypatch):
    """Where windows go out in parts, they add up to the same places."""
    batch = hot_batch(20, 600, "a")

    def places():
        rows = [r for out in suffix_dedup._pack(100)(iter([batch])) for r in out.to_pylist()]
        starts = {}
        for r in rows:
            for m in r["members"]:
                at = [x for s in m["spans"] for x in range(s["start"], s["start"] + s["size"] - 99)]
                starts.setdefault((r["hash_1"], r["hash_2"], m["_id"]), []).extend(at)
        return len(rows), {k: sorted(v) for k, v in starts.items()}, sum(r["n"] for r in rows)

    one, whole, n = places()
    monkeypatch.setattr(buckets, "ROWS", 100)
    parts, same, same_n = places()
    assert parts > one and same == whole and same_n == n


def test_repeated_windows():
    import numpy as np

    data = np.frombuffer(b"xabcdefgyabcdefgz", np.uint8)
    assert suffix_dedup.repeated(data, np.arange(len(data) - 4), 5).nonzero()[0].tolist() == [1, 2, 3, 9, 10, 11]


def test_near(spark, family):
    got = minhash_forest.near_duplicates(frame(spark, family)).collect()
    shown = sorted((brute.NO_ID if r[0] is None else r[0], r[1], brute.NO_ID if r[2] is None else r[2], r[3]) for r in got)
    assert shown == brute.near(family)


@pytest.mark.parametrize("region", [2, 24])
def test_near_crowded(spark, region):
    """A family larger than a region, in which cutting must part nothing."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 80):
        text = list(base)
        text[rng.randrange(300)] = "edit" + str(i)
        rows.append((i, " ".join(text)))
    got = sorted(map(tuple, minhash_forest.near_duplicates(frame(spark, rows), region=region).collect()))
    assert got == brute.near(rows)


@pytest.mark.parametrize("how", [{}, {"block": 16}])
def test_near_base_with_many_copies(spark, how):
    """Copies 0.79 like their base and less than 0.75 like one another; the base's id is in the middle."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(1150, " ".join(base))]
    for i in range(320):
        text = list(base)
        for k in rng.sample(range(1, 59), 7):
            text[5 * k] = f"edit{i}x{k}"
        rows.append((1000 + i + (i >= 150), " ".join(text)))
    got = sorted(map(tuple, minhash_forest.near_duplicates(frame(spark, rows), **how).collect()))
    assert got == brute.near(rows)
    assert {r[2] for r in got} == {1000}


def test_near_shared_counts():
    """Dense and sparse columns, of the same rows and of others."""
    import numpy as np

    rng = np.random.default_rng(5)
    held = rng.random((40, 3000)) < np.r_[np.full(1500, 0.5), np.full(1500, 0.03)]
    row, column = np.nonzero(held)
    for a, b in ((np.arange(40), np.arange(40)), (np.arange(0, 40, 2), np.arange(1, 40, 2))):
        assert (minhash_forest._shared(row, column, a, b) == held[a].astype(int) @ held[b].astype(int).T).all()


def test_near_odd_rows(spark, odd, empty):
    got = minhash_forest.near_duplicates(odd).collect()
    assert sorted((brute.NO_ID if r[0] is None else r[0], r[1], brute.NO_ID if r[2] is None else r[2], r[3]) for r in got) == brute.near(ODD)
    assert minhash_forest.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("missing", [False, True])
def test_many_repeated_rows_cost_their_number(spark, missing):
    """Rows that agree in id and text; the lists that they are cut by do not grow with them."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(None if missing else 1, text)] * 1500 + [(2, text + " end"), (3, "none of it " * 3)]
    df = frame(spark, rows)
    items = minhash_forest.buckets.with_lists(df, superkmer_dedup.repeated_runs(df), ["start", "n"], "left").selectExpr("max(size(items)) AS n")
    assert items.first().n < 300
    told = {(r.doc_id, r.n_words, r.n_removed) for r in superkmer_dedup.dedup_passages(df, keep_text=False).collect()}
    assert told == {(None if missing else 1, 300, 300), (2, 301, 300), (3, 9, 0)}
    cut = suffix_dedup.dedup_bytes(df, keep_text=False).groupBy("doc_id", "n_removed").count().collect()
    assert len(cut) == 3 and sum(r["count"] for r in cut) == len(rows)


def test_ids_link_nothing(spark):
    """Rows without an id, or with one id, are rows of their own: what they are like is not alike for that."""
    one, two = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    rows = [(5, one + " x"), (7, two + " x"), (None, one), (None, two), (9, one + " y"), (9, "c " * 30 + "d")]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash_forest.near_duplicates(frame(spark, rows)).collect()}
    assert got[5, 37] == (5, True) and got[7, 37] == (7, True) and got[9, 37] == (5, False) and got[9, 2] == (9, True)
    assert sorted((brute.NO_ID if r[0] is None else r[0], r[1], brute.NO_ID if r[2] is None else r[2], r[3]) for r in minhash_forest.near_duplicates(frame(spark, rows)).collect()) == brute.near(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 102), (200, 150), (200, 160)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(map(tuple, components.components(df).collect()))
    assert got == dict(map(tuple, components.components(df, at_once=0).collect()))
    pair = df.selectExpr("struct(u AS _id, -u AS _text_hash) AS u", "struct(v AS _id, -v AS _text_hash) AS v")
    assert {r.node._id: r.component._id for r in components.components(pair).collect()} == got
    want = {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)} | {i: 150 for i in (150, 160, 200)}
    assert got == want


def test_lines(spark, odd, empty):
    rows = [(1, "A shared line here\nown one\n"), (2, " a SHARED line here\t\nÜber die Linie\nshort"), (3, "über die linie\nshort"), (None, None), (4, "")]
    df = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", df.where("doc_id IS NOT NULL").toPandas())
    got = line_dedup.line_report(df).collect()
    assert sorted(map(tuple, (r for r in got if r[0] is not None))) == sorted(con.execute(line_dedup.REPORT_SQL).fetchall())
    assert [tuple(r) for r in got if r[0] is None] == [(None, 1, 0, brute.sha(b""))]
    done = line_dedup.dedup_lines(odd)
    assert done.columns == [*odd.columns, "n_lines", "n_dropped"] and done.count() == len(ODD)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert {r.n_dropped for r in line_dedup.dedup_lines(df, min_docs=3).collect()} == {0}
