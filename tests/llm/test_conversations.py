"""The trie of rebuilt conversations, against SQL and a plain version."""

import hashlib
import zlib

import duckdb
import pyarrow as pa

from faretide.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x int, ends boolean"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1, True) for r in rows], SCHEMA)


def turns_of(rows):
    own = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get((abs(c) // 100 * 100) * (1 if c >= 0 else -1), [])
        out[c] = tuple(base[:h] + own[c][h:])
    return out


def plain(rows):
    built = turns_of(rows)
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, found in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) == len(n) + 1 for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in found if built[c] == node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(found), len(node), parent, len(found), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    return sorted((tuple(r) for r in trie.node_report(df, **how).collect()), key=str)


def sample():
    """Families, copies of whole conversations under far ids, prefixes of one another, and turns that all share."""
    rows = []
    for c in [*range(0, 14), *range(95, 130), *range(9000, 9020), -3, -120]:
        for t in range(1 + c % 7):
            rows.append((c, t, "user" if t % 2 == 0 else None, f"turn {t} of {c % 3 if t > 1 else 'all'}é😀"))
    for c in range(5000, 5040):
        rows += [(c, t, "user", f"same {t}") for t in range(9)]
    return rows


ODD = [(None, 0, "user", "lost"), (400, None, "user", "first"), (400, 1, None, None), (400, 2, "user", ""), (401, 0, "user", "a"), (401, 0, "user", "a"), (402, 5, "", "x" * 30000), (77, 3, None, "alone")]


def test_same_as_brute_and_sql(spark):
    rows = sample() + ODD
    want = plain(rows)
    assert got(frame(spark, rows)) == want
    con = duckdb.connect()
    names = ["conv_id", "turn", "role", "text"]
    con.register("conversations", pa.Table.from_pylist([dict(zip(names, r)) for r in rows], pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))
    assert sorted(con.execute(trie.REPORT_SQL).fetchall(), key=str) == want


def test_no_rows(spark):
    assert got(frame(spark, [])) == [] and got(frame(spark, [(None, 1, "user", "x")])) == []


def test_conversation_without_turns(spark):
    # 119 has h = crc32('119') % 6 turns to take from 100, which is absent, and fewer of its own.
    one = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(one, 0, "user", "gone"), (one, 1, "user", "gone too")]
    assert got(frame(spark, rows)) == plain(rows) and len(plain(rows)) == 1


def test_long_lists_of_ends(spark):
    """Ends come in several groups, and over several batches."""
    rows = [(c, 0, "user", "hello") for c in range(0, 30_000, 1) if zlib.crc32(str(c).encode()) % 6 == 0]
    ends = ",".join(str(r[0]) for r in rows)
    found = {r.depth: r for r in trie.node_report(frame(spark, rows)).collect()}
    assert found[1].ends_sha256 == hashlib.sha256(ends.encode()).hexdigest()
    assert found[1].n_convs == found[0].n_convs == len(rows) and found[0].n_leaves == 1
    assert found[0].saved_tokens == 5 * (len(rows) - 1)


def test_leaves_keep_every_sequence(spark):
    rows = sample()
    df = frame(spark, rows)
    built = trie.collapse(df)
    told = {}
    for r in built.leaf_turns(df).collect():
        told.setdefault((r.conv_id, r.weight), []).append((r.depth, r.role, r.text))
    sequences = {tuple(t[1:] for t in sorted(v)): k[1] for k, v in told.items()}
    plain_sequences = list(turns_of(rows).values())
    leaves = {s for s in plain_sequences if not any(o != s and o[: len(s)] == s for o in plain_sequences)}
    assert set(sequences) == leaves and all(n == plain_sequences.count(s) for s, n in sequences.items())
    assert sum(r.weight for r in built.sequences.collect()) == len(plain_sequences)
