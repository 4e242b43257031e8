"""Quality lines, language, licences, leaks, pieces and urls."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faretide.llm import decontaminate, langid, licenses, quality_lines, superkmer_dedup, url_rules
from faretide.llm import sentencepiece_viterbi as sp
from tests.llm import brute
from tests.llm.conftest import ODD


def test_quality_same_as_sql(spark, odd, empty):
    prose = "It was said that the rule of the line is plain, and all of it stays here.\n" * 2
    rows = [(1, prose * 5), (2, "A | b | c | d | e\n" * 20), (3, "BUY!! NOW!! HERE!!\n" + prose * 4), (4, "x#*% y$$ z&&\n" * 30), (5, " \t\n"), (6, "one\ttwo\x0bthree four"), (7, "a b c a b c a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.execute(quality_lines.REPORT_SQL).fetchall())
    got = sorted(map(tuple, quality_lines.quality_report(df).collect()))
    assert got == want
    assert quality_lines.quality_report(odd).count() == len(ODD) and quality_lines.quality_report(empty).count() == 0
    texts = {r.doc_id: r.clean_text for r in quality_lines.clean_lines(df).collect()}
    assert texts[3] == prose * 4 and "|" not in texts[2]


def test_quality_is_columns_only(odd):
    plan = quality_lines.quality_report(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_gradients():
    network = langid.Network(["a", "b", "c"], 3)
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    mask = (np.arange(7)[:, None] < np.array([7, 5, 3, 7, 1])).astype(float)
    label = np.array([0, 1, 2, 0, 1])
    _, grad = network.gradients(data, label, mask)
    for name, values in network.p.items():
        at = np.unravel_index(np.abs(grad[name]).argmax(), values.shape)
        held, losses = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = held + step
            losses.append(network.gradients(data, label, mask)[0])
        values[at] = held
        assert abs((losses[0] - losses[1]) / 2e-5 - grad[name][at]) < 1e-7, name


def test_labels_are_those_of_training():
    """The fast labelling agrees with the states that training reads, position by position."""
    network = langid.Network(["a", "b"], 4, seed=3)
    data = np.frombuffer(b"some bytes to label, twice over", np.uint8)
    ahead = np.stack([x[-1] for x in network._read("f", data[:, None])])[:, 0]
    behind = np.stack([x[-1] for x in network._read("b", data[::-1, None])])[::-1, 0]
    logits = ahead @ network.p["f_out"] + behind @ network.p["b_out"]
    want = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    got = network.single().positions(data, np.array([0]), np.array([len(data)]))[:, 0]
    assert np.allclose(got, want, atol=1e-4)
    means, votes = network.documents(data, np.array([0, len(data), len(data)]), 8)
    assert means.shape == (2, 2) and abs(means[0].sum() - 1) < 1e-5 and votes[1].sum() == 0


def test_short_segments_read_no_foreign_memory(monkeypatch):
    """Whatever np.empty finds in memory, short and long texts of a batch get the same probabilities."""
    network = langid.Network(["a", "b", "c"], 4, seed=5).single()
    data = np.frombuffer(b"x" * 300 + b"short" + b"some more bytes, of another length" * 3, np.uint8)
    bounds = np.array([0, 300, 305, 305, len(data)])
    want = network.documents(data, bounds, 128)
    plain = np.empty

    def poisoned(shape, dtype=float, **how):
        out = plain(shape, dtype, **how)
        if np.issubdtype(out.dtype, np.floating):
            out.fill(np.nan)
        return out

    monkeypatch.setattr(np, "empty", poisoned)
    got = network.documents(data, bounds, 128)
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and abs(got[0][[0, 1, 3]].sum() - 3) < 1e-4


def test_language_at_default_parameters(spark):
    """Held-out accuracy, in a session whose Python workers have done other work before."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    superkmer_dedup.dedup_passages(docs, keep_text=False).count()
    told = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = told.where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").select("lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 200 and right >= 0.98 * len(rows)
    assert all(0 < r.score < 1 for r in rows)


def test_language(spark, documents, odd, empty):
    told = langid.language_report(documents, per_lang=60, steps=80)
    both = told.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in both)
    assert right >= 0.85 * len(both)
    assert all(0 <= r.score <= 1 for r in both)
    network = langid.Network(["en", "fr"]).single()
    plain = odd.drop("score")
    got = langid.identify(plain, network).collect()
    assert [r.lang_pred for r in got if r.doc_id in (1, 2, 3)] == ["und"] * 3 and len(got) == len(ODD)
    assert all(r.lang_pred in ("en", "fr") for r in got if r.doc_id not in (1, 2, 3))
    assert {r.lang_pred for r in langid.language_report(plain.where("doc_id = 1")).collect()} == {"und"}
    assert langid.language_report(empty).count() == 0


def test_licences(spark, odd, empty):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."),
        (2, "so: Licensd under the GNU Generall Public License, then"),
        (3, "MIT\nlicense and CC-BY 4.0, CC BY-NC"),
        (4, "Permission is hereby granted, free of charge, to any persn, and more"),
        (5, "nothing of that kind, mit licenses"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].base_labels) == (8, 1, 3, "apache")
    assert (got[2].n_base, got[2].first_word, got[2].labels) == (0, None, "gpl") and 0.9 < got[2].score < 1
    assert (got[2].spans[0].first_word, got[2].spans[0].edits) == (1, 2)
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (3, 0, 7, "cc-by,mit")
    assert (got[4].base_labels, got[4].labels) == ("", "mit")
    assert (got[5].labels, got[5].score) == ("", 0.0)
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(empty).count() == 0


def test_pigeonhole_pieces_cover_the_notice():
    for notice in licenses.NOTICES:
        parts = licenses.pieces(notice, 3)
        assert "".join(p for _, p in parts) == notice and len(parts) == 4


def test_leaks(spark, odd, empty):
    items = [(1, "The quick brown fox jumps over the lazy dog while nine old men watch it go by"), (2, None), (3, "two words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    w = items[0][1].split()
    rows = [
        (1, "zz " + " ".join(w).upper() + " yy"),
        (2, " ".join(w[9:]) + " and then: " + " ".join(w[:9])),
        (3, " ".join(w[:6]) + " other words"),
        (4, "here are two words."),
        (None, "x, " + ", ".join(w)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block_words in (1, 10**6):
        found = decontaminate.leaks(docs, benchmark, block_words=block_words).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.covered) for r in found) == [(0, 1, 17), (1, 1, 17), (2, 1, 17), (4, 3, 2)]
    assert [t.words for r in found if r.doc_id == 2 for t in r.tiles] == [9, 8]
    assert [r.doc_id for r in decontaminate.drop_leaking(docs, benchmark).collect()] == [3]
    assert decontaminate.leaks(odd, benchmark).count() == 0 and decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.where("false")).count() == 0


def test_tiles_never_overlap():
    item = np.array([1, 2, 3, 4, 5, 6], np.uint64)
    text = np.array([4, 5, 6, 9, 1, 2, 3, 4, 5], np.uint64)
    seeds = [(a, b) for a in range(5) for b in range(8) if list(item[a : a + 2]) == list(text[b : b + 2])]
    assert sorted(decontaminate.tile(item, text, seeds, 2)) == [(0, 4, 5)]


def test_every_notice_of_a_joined_span_is_found():
    find = licenses.Finder(licenses.NOTICES, licenses.PHRASES, 0.08, 3)
    found = find.notices_in(" licensed under the mit licence licensed under the mit license ")
    assert [(edits, low) for _, low, _, edits, _ in found if edits >= 0][:2] and len({low // 30 for _, low, *_ in found}) == 2
    rng = np.random.default_rng(4)
    notices = list(licenses.NOTICES)
    for _ in range(60):
        planted, parts = [], []
        for _ in range(int(rng.integers(1, 5))):
            k = int(rng.integers(len(notices)))
            notice, own = notices[k], list(notices[k])
            for at in rng.choice(len(own), int(rng.integers(0, find.edits[k] + 1)), replace=False):
                own[at] = "z"
            low = sum(len(p) + 1 for p in parts) + 1
            parts.append("".join(own))
            planted.append((licenses.NOTICES[notice], low, low + len(own)))
            parts += ["qq"] * int(rng.integers(0, 3))
        told = find.notices_in(" " + " ".join(parts) + " ")
        for label, low, high in planted:
            assert any(n == label and a < high and low < b for n, a, b, *_ in told), (parts, told)


def moved_passages(seed, items=12, docs=40):
    """Items over few words, and texts of their pieces in other orders, with words changed here and there."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(9)]
    benchmark = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(items)]
    rows = []
    for d in range(docs):
        parts = []
        for i in rng.choice(items, rng.integers(1, 4)):
            own = benchmark[i][1].split()
            cut = sorted(rng.integers(0, len(own) + 1, 2))
            pieces = [own[cut[0] : cut[1]], own[: cut[0]], own[cut[1] :], list(rng.choice(words, rng.integers(0, 6)))]
            parts += [w if rng.random() > 0.03 else "changed" for k in rng.permutation(4) for w in pieces[k]]
        rows.append((d, " ".join(parts)))
    return benchmark, rows


def test_tiles_same_as_brute():
    for seed in range(6):
        benchmark, rows = moved_passages(seed)
        block = decontaminate.Block([i for i, _ in benchmark], [t for _, t in benchmark], 3, 0.01)
        for _, text in rows[:10]:
            own = {i: found for _, i, found in block.find(pa.array([text]))}
            for k, (_, item) in enumerate(benchmark):
                item = item.split()
                want = brute.tiles(item, text.split(), min(3, len(item)))
                assert own.get(k, []) == want, (item, text)


def test_leaks_same_as_brute(spark):
    benchmark, rows = moved_passages(11, docs=120)
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    want = []
    for d, text in rows:
        for i, item in benchmark:
            item = item.split()
            covered = sum(n for _, _, n in brute.tiles(item, text.split(), min(5, len(item))))
            if covered >= 0.6 * len(item):
                want.append((d, i, covered, len(item)))
    for block_words in (40, 10**6):
        found = decontaminate.leaks(docs, table, block_words=block_words).collect()
        assert sorted((r.doc_id, r.item_id, r.covered, r.item_words) for r in found) == sorted(want) and len(want) > 50
        left = decontaminate.drop_leaking(docs.withColumn("_row", docs.doc_id), table, block_words=block_words).collect()
        assert sorted(r.doc_id for r in left) == sorted({d for d, _ in rows} - {d for d, *_ in want})
    plan = decontaminate.drop_leaking(docs, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.fixture(scope="module")
def model():
    try:
        import public_tokenizers as tokenizers
    except ImportError:
        pytest.skip("no piece file")
    with open(tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


TEXTS = ["Hello  world", "", " lead and trail ", "Größe 漢字 \U0001f600", "a", "\n\t x", "heitkeit und tion of the thing", "   "]


def test_pieces(model):
    automaton = sp.Automaton(model)
    scores = {}
    least = min(s for _, s, k in automaton.pieces if k == sp.NORMAL)
    for byte in range(256):
        scores[bytes([byte])] = least - 10
    for piece, score, kind in automaton.pieces:
        if kind == sp.NORMAL:
            scores[piece] = max(score, scores.get(piece, float("-inf")))
    by_id = [scores.get(p, least - 10) for p, _, _ in automaton.pieces]
    for text, ids in zip(TEXTS, automaton.encode(TEXTS)):
        normal = (sp.META + text.encode().replace(b" ", sp.META)) if text else b""
        assert sum(by_id[i] for i in ids) == pytest.approx(brute.best_score(normal, scores))
        assert automaton.decode(ids.tolist()) == text


def test_pieces_as_the_library_would(model):
    """The library, told that the file is a unigram model, finds segmentations of the same score."""
    import sentencepiece

    at = next(i for i in range(len(model) - 1, 0, -1) if model[i : i + 2] == b"\x18\x02" and b"\n" in model[i - 400 : i])
    try:
        library = sentencepiece.SentencePieceProcessor(model_proto=model[:at] + b"\x18\x01" + model[at + 2 :])
    except Exception:
        pytest.skip("the file cannot be relabelled")
    automaton = sp.Automaton(model)
    for text in ["heitkeit und tion of the thing", "plain words only"]:
        own = automaton.encode([text])[0].tolist()
        score = lambda ids: sum(library.GetScore(int(i)) for i in ids)
        assert score(own) >= score(library.encode(text)) - 1e-3


def test_pieces_over_frames(spark, model, odd, empty):
    got = sp.round_trip(odd, model).collect()
    assert all(r.same for r in got) and len(got) == len(ODD)
    assert [r.ids for r in got if r.doc_id == 1] == [None] and [r.ids for r in got if r.doc_id == 2] == [[]]
    assert sp.encode(odd, model).columns == [*odd.columns, "ids", "n_ids"]
    assert sp.round_trip(empty, model).count() == 0
    with pytest.raises(ValueError):
        sp.encode(odd.withColumnRenamed("items", "IDS"), model)


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
    rest = rest[:cut]
    slash = rest.find("/") if "/" in rest else len(rest)
    host, path = rest[:slash].translate(brute.LOWER), rest[slash:]
    fits = [r for r in url_rules.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_urls(spark):
    urls = [None, "nothing", "http://WWW.Example.com/en/x?y#z", "http://a.net:80/es/1", "x://com", "http://example.com/en/", "http://notexample.com/en/", "http://b.net/es/x", "http://c.d.net/fr/?a=1", "http://e.org#f", "http://q.com?x=/en/"]
    urls += [f"http://h{i}.example.com/en/{i}" for i in range(30)] + [f"http://h{i}.site.com/de/{i}" for i in range(30)] + [f"http://o{i}.org/en/{i}" for i in range(5)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_rules.judge(pages).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    learned = {tuple(r.learned): r.verdict for r in got if r.learned}
    assert learned and all(r.verdict == "block" for r in got if r.url and r.url.startswith("http://o"))
    assert url_rules.judge(pages.where("false")).count() == 0


def test_learned_verdicts_same_as_brute(spark):
    """Every learned rule against every url, without an index; a token set that most urls share among them."""
    rng = np.random.default_rng(6)
    part = lambda *choices: str(rng.choice(choices))
    urls = [f"http://{part('a', 'b', 'www')}.{part('shop', 'news', 'example')}.{part('com', 'net', 'org', 'io')}/{part('en', 'es', 'fr', 'x')}/{part('p', 'q')}{rng.integers(99)}?{part('id', 'lang')}=1" for _ in range(300)]
    urls += ["https://many.org/a/b"] * 120 + [None, "none", "ftp://.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    host, path = url_rules.host_and_path(F.coalesce("url", F.lit("")))
    base = pages.select("*", host.alias("host"), path.alias("path"))
    base = base.select("page_id", "url", url_rules.by_rules(F.col("host"), F.col("path"), url_rules.RULES).alias("g"), url_rules.tokens(F.coalesce("url", F.lit("")), F.col("host"), F.col("path")).alias("tokens"))
    labelled = base.where("g IS NOT NULL").select("tokens", F.col("g.verdict").alias("label"), F.xxhash64("url").alias("order"))
    rules = url_rules.learn(labelled).collect()
    got = {r.page_id: r for r in url_rules.judge(pages).collect()}
    assert len(got) == len(urls) and len(rules) > 5
    learned = 0
    for r in base.collect():
        fitting = [(x.confidence, len(x.tokens), x.support, x.label == "block", x.label) for x in rules if set(x.tokens) <= set(r.tokens)]
        want = r.g.verdict if r.g else max(fitting)[-1] if fitting else "allow"
        assert got[r.page_id].verdict == want, (r.url, fitting)
        assert (got[r.page_id].learned is not None) == (r.g is None and bool(fitting))
        learned += r.g is None and bool(fitting)
    assert learned > 120


def test_learned_rules_are_pruned_and_right(spark):
    rows = [(["a", "b"], "block", i) for i in range(8)] + [(["a", "c"], "allow", i) for i in range(8)] + [(["a", "b", "d"], "block", 99)]
    rules = url_rules.learn(spark.createDataFrame(rows, "tokens array<string>, label string, order long"), min_support=0.05)
    got = {(tuple(r.tokens), r.label): r.confidence for r in rules.collect()}
    assert got == {(("b",), "block"): 1.0, (("c",), "allow"): 1.0, (("d",), "block"): 1.0}
