"""Top-k search and vector codes, against plain versions and SQL."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from faretide.llm import norm_buckets, vector_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string, mark double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "extra", 0.5) for i, v, label in rows], SCHEMA)


def random_rows(n, dims, seed=0, hot=0):
    """Lengths that differ widely, some clusters, and ``hot`` copies of one vector under other ids."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, dims))
    rows = []
    for i in range(n):
        v = centres[i % 5] * rng.lognormal(0, 0.7) + rng.normal(0, 0.05 if i % 3 else 1, dims)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 4 if i % 7 else None))
    same = rows[n // 2][1]
    return rows + [(n + i, same, 9) for i in range(hot)]


BAD = [(1000, None, 1), (1020, [1.0, None], 1), (1040, [1.0, float("nan")], None), (1060, [float("inf"), 0.0], 2), (None, None, None)]


def plain_top(rows, k, every=20, scale=64):
    whole = {}
    for i, v, _ in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i, tuple(math.floor(scale * x) for x in v) if any(v) else ()] = [math.floor(scale * x) for x in v]
    out = []
    for (q, _), v in whole.items():
        if q is None or q % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), 2**63 if c is None else c) for (c, _), w in whole.items() if c != q]
        out += [(q, rank, None if c == 2**63 else c, -s) for rank, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"bucket_bytes": 700, "lanes": 2}, {"bucket_bytes": 700, "lanes": 1, "steep": 0.0}, {"bucket_bytes": 1500, "lanes": 3, "block_queries": 4, "steep": 2.0}])
def test_top_k_same_as_brute(spark, how):
    rows = random_rows(260, 9, hot=80) + BAD + [(None, [0.5] * 9, 1), (20, random_rows(40, 9)[20][1], 3)]
    want = plain_top(rows, 7)
    got = sorted((tuple(r) for r in norm_buckets.top_k(frame(spark, rows), k=7, **how).collect()), key=str)
    assert got == want and len(got) == 7 * 17


def test_top_k_odd_rows(spark):
    # Vectors of several sizes, empty ones, repeated rows, negative ids, fewer rows than k, a query of zeros.
    rows = [(0, [0.0, 0.0], 1), (0, [0.0, 0.0], 1), (20, [], 1), (-40, [1.0, -1.0, 2.0], 2), (3, [1.0], None), (5, [-2.0, 1.0, 4.0, 1.0], 1), (7, [1.0], 1), *BAD]
    got = sorted((tuple(r) for r in norm_buckets.top_k(frame(spark, rows)).collect()), key=str)
    assert got == plain_top(rows, 20)
    assert norm_buckets.top_k(frame(spark, [])).count() == 0 and norm_buckets.top_k(frame(spark, BAD)).count() == 0
    assert norm_buckets.top_k(frame(spark, [(1, [1.0], 1)])).count() == 0
    with pytest.raises(Exception, match="exact"):
        norm_buckets.top_k(frame(spark, [(0, [3e30], 1), (1, [1.0], 1)])).count()


def test_top_k_shows_no_pairs(spark):
    plan = norm_buckets.top_k(frame(spark, random_rows(50, 4)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_pruning_leaves_most_out(monkeypatch):
    """Of buckets of short vectors, and of slices that the angle rules out, nothing is multiplied."""
    rng = np.random.default_rng(1)
    pack = lambda ids, rows: {"dims": rows.shape[1], "ids": ids.astype("<i8").tobytes(), "marks": ids.astype("<i8").tobytes(), "code": rows.astype("<i4").tobytes()}
    query = np.zeros((1, 32))
    query[0, 3] = 100
    block = norm_buckets.Block([pack(np.array([0]), query)], 5, 0.9)
    near = np.round(query + rng.normal(0, 2, (20, 32)))
    block.meet(pack(np.arange(1, 21), near[np.argsort(-(near**2).sum(1))]))
    seen = []
    plain = norm_buckets.Block._verify
    monkeypatch.setattr(norm_buckets.Block, "_verify", lambda self, asking, ids, rows: (seen.append(len(ids)), plain(self, asking, ids, rows)))
    other = rng.normal(0, 1, (1000, 32))
    other = np.round(102 * other / np.linalg.norm(other, axis=1, keepdims=True))
    block.meet(pack(np.arange(100, 1100), other[np.argsort(-(other**2).sum(1))]))
    assert sum(seen) < 20
    before = len(seen)
    block.meet(pack(np.arange(2000, 3000), np.ones((1000, 32))))
    assert len(seen) == before


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max([len(v) for _, v, _ in kept], default=0)
    width = max(1, -(-dims // parts))
    whole = [[math.floor(4096 * x) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    first = {}
    for (i, _, _), w, c in sorted(zip(kept, whole, cut), key=lambda r: (2**63 if r[0][0] is None else r[0][0], r[1])):
        first.setdefault(i, c)
    books = [[list(c[p]) for c in list(first.values())[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        told = [[nearest(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, t in zip(cut, told) if t[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    told = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in t) for t in told]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    import hashlib

    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in t), e, by_label[label], sha) for (i, _, label), t, e in zip(kept, told, errors)), key=str)


@pytest.mark.parametrize("dims", [8, 24, 27, 64])
def test_codes_same_as_brute(spark, dims):
    rows = random_rows(90, dims, seed=dims, hot=30) + BAD
    got = sorted((tuple(r) for r in vector_codes.compress(frame(spark, rows)).collect()), key=str)
    assert got == plain_codes(rows) and len(got) == 120


def test_codes_odd_rows(spark):
    rows = [(4, [1.0, -1.0], None), (4, [0.5, 9.0], None), (4, [1.0, -1.0], 3), (None, [], 3), (2, [0.25] * 11, 3), (-7, [0.0] * 3, 1), (None, [1.0], 1), *BAD]
    got = sorted((tuple(r) for r in vector_codes.compress(frame(spark, rows)).collect()), key=str)
    assert got == plain_codes(rows) and len(got) == 7
    only_ids_missing = [(None, [1.0, 2.0], None), (None, [1.0, 1.0], None)]
    got = sorted((tuple(r) for r in vector_codes.compress(frame(spark, only_ids_missing)).collect()), key=str)
    assert got == plain_codes(only_ids_missing)
    for none in ([], BAD):
        assert vector_codes.compress(frame(spark, none)).collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(frame(spark, [(1, [3e30], 1)])).count()


def test_transform_keeps_distances():
    rng = np.random.default_rng(3)
    x, y = rng.integers(-1000, 1000, (2, 50, 16))
    assert np.array_equal(((vector_codes.hadamard(x) - vector_codes.hadamard(y)) ** 2).sum(1), 16 * ((x - y) ** 2).sum(1))
    rows = vector_codes.hadamard(np.eye(16, dtype=np.int64))[vector_codes.by_sequency(16)]
    assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(16))


def test_nearest_prefers_the_lower_of_equals():
    entries = np.array([[[0, 4], [4, 0], [0, 4], [9, 9]]])
    codes, far = vector_codes.Books(entries).nearest(0, np.array([[0, 4], [2, 2], [4, 1], [8, 9]]))
    assert codes.tolist() == [0, 0, 1, 3] and far.tolist() == [0, 8, 1, 1]


def test_whole_numbers():
    here, rows = vectors.whole(pa.array([[0.5, -0.01], None, [float("nan")], [None], []], pa.list_(pa.float32())), 64)
    assert here.tolist() == [0, 4] and rows.tolist() == [[32.0, -1.0], [0.0, 0.0]]


@pytest.mark.parametrize("sql, run", [(norm_buckets.REPORT_SQL, norm_buckets.top_k), (vector_codes.REPORT_SQL, vector_codes.compress)])
def test_vectors_same_as_sql(spark, sql, run):
    rows = random_rows(150, 16, seed=8, hot=20) + BAD
    con = duckdb.connect()
    con.register("embeddings", pa.Table.from_pylist([{"vec_id": i, "embedding": v, "label": x} for i, v, x in rows], pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])))
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    got = run(frame(spark, rows)).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, result.fetchall()))
