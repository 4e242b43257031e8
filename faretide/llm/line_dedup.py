r"""Lines that several documents share: explode, hash, count documents per hash, drop, put together again.

Defined results: a null or empty text is one empty line and stays; a null doc_id comes after all ids; rows that share a
doc_id are one document; extra columns are ignored by ``line_report`` and kept by ``dedup_lines``; an empty table gives
an empty result.

Every line costs two narrow rows (hash, id), never its text. A line of a third of all documents is one row per task in
the count, and its join rows can be split by Spark's skew handling, as no step needs them together. Texts move once,
to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm import common

SECOND_SEED = 1
HASH = ["hash_1", "hash_2"]


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z in lower case."""
    bare = F.btrim(line, F.lit(common.SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, common.UPPER, common.LOWER))


def _hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_id, _text_hash, pos, hash_1, hash_2) of every line whose key is long enough; the two are a 128-bit hash of the key."""
    exploded = common.keyed(docs).select("_id", "_text_hash", F.posexplode(common.lines(F.col("text"))).alias("pos", "line"))
    # Lower case leaves the number of code points as it is, so the length is known before.
    long_enough = exploded.where(F.char_length(F.btrim("line", F.lit(common.SPACE))) >= min_chars)
    key = line_key(F.col("line"))
    return long_enough.select(
        "_id", "_text_hash", "pos", F.xxhash64(key).alias("hash_1"), F.xxhash64(F.lit(SECOND_SEED), key).alias("hash_2")
    )


def dropped_positions(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(_id, _text_hash, dropped): positions of the lines that another, earlier document keeps."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    hashes = _hashes(docs, min_chars)
    if min_docs == 2:  # two different ids are told by the smallest and the largest, without a set
        per_hash = hashes.groupBy(*HASH).agg(F.min("_id").alias("first_id"), F.max("_id").alias("last_id"))
        shared = per_hash.where("first_id < last_id").select(*HASH, "first_id")
    else:
        per_doc = hashes.groupBy(*HASH, "_id").agg(F.lit(1).alias("one"))
        per_hash = per_doc.groupBy(*HASH).agg(F.min("_id").alias("first_id"), F.count("one").alias("n_docs"))
        shared = per_hash.where(F.col("n_docs") >= min_docs).select(*HASH, "first_id")
    shared = common.apart(shared, HASH, "key").select("key", "hash_2", "first_id")
    repeats = common.apart(hashes, HASH, "key").join(shared, ["key", "hash_2"]).where("_id > first_id")
    return repeats.groupBy("_id", "_text_hash").agg(F.array_distinct(F.collect_list("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and ``n_lines`` and ``n_dropped`` behind the other columns."""
    extra = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        common.order_id().alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash"),
        "doc_id",
        "text",
        F.struct(*extra).alias("_rest") if extra else F.lit(None).alias("_rest"),
    )
    joined = rows.join(dropped_positions(docs, min_chars, min_docs), ["_id", "_text_hash"], "left")
    all_lines = common.lines(F.col("text"))
    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    # Positions left over, by a hash set: in step with the number of lines.
    left = common.let(
        all_lines,
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: x[i]), "\n"
        ),
    )
    text = F.when(F.size(gone) == 0, F.col("text")).otherwise(left)
    column = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col("_rest")[c] for c in extra}
    return joined.select(
        *(column[c].alias(c) for c in docs.columns),
        F.size(all_lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
    )


def line_report(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 of what is left."""
    done = dedup_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The same result over the table ``documents``.
REPORT_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keys AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first_id FROM keys WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), told AS (
  SELECT doc_id, pos, line, shared.key IS NOT NULL AND doc_id > first_id AS gone FROM keys LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
