r"""Line-first cleaning: rules judge single lines, failed lines go, and a text that loses too much goes as a whole.

Everything is column arithmetic over one scan: no shuffle, no join, no Python. A text's words and lines become arrays
once; repeated three-word windows are found by sorting (hash, position) pairs inside the row, so a long text costs
n log n. The windows are compared by 64-bit hashes within one text.

Defined results: a null or empty text has no words and no lines to judge, fails the base rules and is not kept; extra
columns are ignored by ``quality_report`` and kept by ``clean_lines``; repeated rows are judged alike, each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm import common

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Phrases of page furniture, in lower case.
BOILERPLATE = [
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "use cookies",
    "enable javascript",
    "click here",
    "read more",
    "sign up",
    "log in",
    "subscribe to",
    "share this",
    "skip to content",
    "back to top",
    "lorem ipsum",
]

#: A sentence ends so within its last eight characters, closing quotes and brackets included.
SENTENCE_END = r"""[.!?:;,\x{2026}]["')\]\x{201D}\x{2019}\x{00BB}]*$"""
#: Menu separators.
MENU = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}]"
ANY_MARK = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}#*$%&<>]"
FURNITURE = rf"(?i)\b(?:{'|'.join(BOILERPLATE)})\b"


def split_words(text: Column) -> Column:
    """The words; a text whose only white space is blanks and line feeds needs no pattern."""
    whole = F.coalesce(text, F.lit(""))
    odd = F.lit(False)
    for space in common.SPACE:
        if space not in " \n":
            odd = odd | F.contains(whole, F.lit(space))
    parts = F.when(odd, F.split(whole, WORD_GAP, -1)).otherwise(F.split(F.replace(whole, F.lit("\n"), F.lit(" ")), " ", -1))
    return F.filter(parts, lambda word: word != "")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(common.SPACE)) != ""


def suspicions(text: Column) -> Column:
    """What a whole text must hold for a rule to fail any of its lines; most texts hold none and are spared the patterns."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(
        F.contains(whole, F.lit("!!")).alias("shouts"),
        whole.rlike(ANY_MARK).alias("marks"),
        whole.rlike(FURNITURE).alias("furniture"),
    )


def line_faults(bare: Column, suspect: Column, min_menu_marks: int = 3) -> dict[str, Column]:
    """Each rule's verdict on a line that has words, without outer white space; true means that the line fails.

    ``suspect`` is what ``suspicions`` says of the text. The word count comes last, so only suspect lines are split.
    """
    n_words = F.size(F.split(bare, WORD_GAP, -1))

    def more_than(mark: str, least: int, times: int) -> Column:
        return common.let(F.regexp_count(bare, F.lit(mark)), lambda n: (n >= least) & (n * times > n_words))

    return {
        "punctuation": ~F.substring(bare, -8, 8).rlike(SENTENCE_END) | (suspect["shouts"] & more_than("!!", 1, 2)),
        "navigation": suspect["marks"] & more_than(MENU, min_menu_marks, 4),
        "boilerplate": (suspect["furniture"] & bare.rlike(FURNITURE) & (n_words < 25))
        | (suspect["marks"] & more_than(SYMBOLS, 1, 1)),
    }


def failed_lines(text: Column) -> Column:
    """The lines that a rule fails; a line without words is not judged."""

    def judge(suspect: Column):
        def one(bare: Column) -> Column:
            faults = line_faults(bare, suspect)
            return (bare != "") & (faults["punctuation"] | faults["navigation"] | faults["boilerplate"])

        return lambda line: common.let(F.btrim(line, F.lit(common.SPACE)), one)

    return common.let(suspicions(text), lambda suspect: F.filter(common.lines(text), judge(suspect)))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more."""

    def beside(s: Column, same) -> Column:
        """The members of a sorted array with a neighbour that is the ``same``."""
        return F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | same(x, F.get(s, i - 1)))

    def count(w: Column, low: Column) -> Column:
        # First one long each, with the position in the hash's low bits: sorts fast and tells the suspects.
        high = lambda x: x.bitwiseAND(F.bitwise_not(low))
        packed = F.transform(
            F.sequence(F.lit(0).cast("long"), F.size(w).cast("long") - 3),
            lambda i: high(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))).bitwiseOR(i),
        )
        suspects = common.let(F.sort_array(packed), lambda s: beside(s, lambda x, y: high(x) == high(y)))
        # Then the words themselves of those.
        spelled = F.transform(
            F.transform(suspects, lambda x: x.bitwiseAND(low)),
            lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("at")),
        )
        repeats = common.let(
            F.sort_array(spelled),
            lambda s: beside(s, lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])),
        )
        # From one window to the next, at most three words are new.
        return F.aggregate(
            F.sort_array(F.transform(repeats, lambda x: x["at"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
            lambda a, at: F.struct((a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")),
            lambda a: a["n"],
        )

    def of(w: Column) -> Column:
        low = (F.pow(F.lit(2), F.ceil(F.log2(F.size(w)))) - 1).cast("long")
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(common.let(low, lambda bits: count(w, bits)))

    return common.let(words, of)


def lost_words(text: Column) -> Column:
    """Words on lines that fail."""
    return F.aggregate(
        failed_lines(text),
        F.lit(0),
        lambda n, line: n + F.size(F.split(F.btrim(line, F.lit(common.SPACE)), WORD_GAP, -1)),
    )


def _share(lost: Column, n_words: Column) -> Column:
    return F.when(n_words == 0, F.lit(0.0)).otherwise(1 - (n_words - lost) / n_words)


def clean_lines(docs: DataFrame, max_lost: float = 0.5) -> DataFrame:
    """``docs`` with ``clean_text``, ``lost_share`` (of the words) and ``rejected`` behind its columns."""
    if not 0 <= max_lost <= 1:
        raise ValueError("max_lost is a share")
    text = F.col("text")
    kept = common.let(
        failed_lines(text), lambda failed: F.filter(common.lines(text), lambda line: ~F.array_contains(failed, line))
    )
    share = _share(lost_words(text), F.size(split_words(text)))
    return docs.select(
        "*", F.array_join(kept, "\n").alias("clean_text"), share.alias("lost_share"), (share > max_lost).alias("rejected")
    )


def quality_report(docs: DataFrame, max_lost: float = 0.5) -> DataFrame:
    """Per document: the base counts, base_failed, and kept: neither that nor rejected by the line rules.

    One struct holds all that needs the words, so that a text is split once.
    """
    if not 0 <= max_lost <= 1:
        raise ValueError("max_lost is a share")
    text = F.coalesce("text", F.lit(""))
    of_words = common.let(
        split_words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    worded = F.filter(common.lines(text), has_word)
    counted = docs.select(
        "doc_id",
        of_words.alias("w"),
        F.when(text.rlike(ANY_MARK), F.regexp_count(text, F.lit(SYMBOLS))).otherwise(0).cast("long").alias("n_symbols"),
        common.let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        lost_words(text).alias("lost"),
    )
    n_words = F.col("w.n_words")
    failed = (n_words < 50) | (100 * F.col("w.n_repeat_words") > 50 * n_words)
    share = _share(F.col("lost"), n_words)
    return counted.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
        failed.alias("base_failed"), (~failed & ~(share > max_lost)).alias("kept"), share.alias("lost_share"),
    )


#: The same result over the table ``documents``, for texts of letters that both engines lower-case alike.
REPORT_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts
), bare AS (
  SELECT r, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare FROM lines
), counted AS (
  SELECT *, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS n, len(regexp_extract_all(bare, '[|\x{{00BB}}\x{{203A}}\x{{2022}}\x{{00B7}}]')) AS menu,
    len(regexp_extract_all(bare, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(bare, '!!')) AS shouts
  FROM bare WHERE bare <> ''
), judged AS (
  SELECT r, line, n, NOT regexp_matches(right(bare, 8), '[.!?:;,\x{{2026}}]["'')\]\x{{201D}}\x{{2019}}\x{{00BB}}]*$') OR shouts * 2 > n
    OR menu >= 3 AND menu * 4 > n OR regexp_matches(bare, '{FURNITURE}') AND n < 25 OR symbols > n AS failed
  FROM counted
), per_text AS (
  SELECT r, sum(n) AS n_words, sum(n) FILTER (WHERE NOT failed) AS n_left, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM judged GROUP BY r
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)
), windows AS (
  SELECT r, pos, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS win FROM words WINDOW o AS (PARTITION BY r ORDER BY pos)
), twice AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, win) AS c FROM windows WHERE win IS NOT NULL) WHERE c > 1
), covered AS (
  SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, pos + k AS pos FROM twice, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY r
), done AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    CASE WHEN coalesce(n_words, 0) = 0 THEN 0 ELSE 1 - coalesce(n_left, 0)::DOUBLE / n_words END AS lost_share
  FROM texts LEFT JOIN per_text USING (r) LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_share <= 0.5 AS kept, lost_share
FROM done
"""
