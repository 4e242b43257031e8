"""The pipeline against plain versions of its stages, and the registered queries."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from faretide.llm import queries
from tests.llm import brute
from tests.llm.conftest import ODD

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.common.saved(stage(spark, before, FOLDER))
        assert docs.columns == documents.columns, name
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            assert sorted(r.doc_id for r in docs.collect()) == [d for d, _, c, kept in brute.near(rows) if kept]
        else:
            assert docs.count() <= before.count()
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert ids.where("NOT same").count() == 0 and ids.count() == docs.count()


def without_shared_lines(rows):
    """Plain line dedup of (doc_id, text) with different ids."""
    key = lambda line: line.strip(brute_space).translate(brute.LOWER)
    holders = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(d)
    gone = lambda d, line: len(key(line)) >= 10 and len(holders[key(line)]) > 1 and min(holders[key(line)]) != d
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not gone(d, line)]
        if len(kept) == len(lines):
            out.append((d, text))
        elif "\n".join(kept).strip(brute_space):
            out.append((d, "\n".join(kept)))
    return out


brute_space = " \t\n\x0b\f\r"


def words_of(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").translate(brute.LOWER))


def leaks(text, items):
    words = words_of(text)
    runs = {tuple(words[i : i + k]) for k in {min(5, len(x)) for x in items if x} for i in range(len(words) - k + 1)}
    for item in items:
        least = min(5, len(item))
        if item and any(tuple(item[i : i + least]) in runs for i in range(len(item) - least + 1)):
            if sum(n for _, _, n in brute.tiles(item, words, least)) >= 0.6 * len(item):
                return True
    return False


def test_run_same_as_plain_stages(spark, documents):
    """run() against plain versions, stage after stage; of language ID, which is trained, the stage itself."""
    network_kept = corpus_pipeline.common.saved(corpus_pipeline.language_id(spark, documents, FOLDER))
    rows = without_shared_lines([(r.doc_id, r.text) for r in network_kept.select("doc_id", "text").collect()])
    alike = {d for d, n, c, kept in brute.near(rows) if n and not kept}
    rows = [(d, t) for d, t in rows if d not in alike]
    items = [words_of(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not leaks(t, items)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    want = corpus_pipeline.token_ids(spark, plain, FOLDER)
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert 0 < len(rows) < documents.count() and got.where("NOT same").count() == 0


def test_stages_on_odd_rows(spark, odd, empty):
    for rows in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, FOLDER).columns == rows.columns, name
    assert corpus_pipeline.near_duplicates(spark, odd, FOLDER).count() == len({d for d, _ in ODD})


def test_near_duplicates_of_shared_and_missing_ids(spark):
    """Only alike texts are dropped; ids that repeat or are missing neither link nor drop."""
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(100)) for name in "abcd")
    rows = [(5, f"{a} x"), (7, f"{b} x"), (None, a), (None, b), (None, c), (9, c), (9, d), (9, d), (8, ""), (8, None), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = map(tuple, corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect())
    want = [(5, f"{a} x"), (7, f"{b} x"), (9, c), (9, d), (8, ""), (8, None), (None, " ")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_operator_is_registered():
    names = sorted(queries.QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(names) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    assert compare.compare(spark, compare.connect(FOLDER), FOLDER, name) is None
