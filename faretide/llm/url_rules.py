r"""URL filters by association rules.

Given rules decide the urls they fit; the longest fitting one wins. Those verdicts are the labels from which Spark's
FP-growth mines combinations of url tokens: a combination that implies a label with enough confidence and support, and
that says more than each of its parts, is a learned rule. Urls that no given rule fits are judged by the learned rules:
an inverted index leads from each url's tokens to the rules whose rarest token it holds, and a rule applies if the url
holds all its tokens. The most confident rule wins, then the one with more tokens, then more support, then block.
Without any rule the verdict is ``default``.

A url's tokens: its host's last three suffixes and its subdomain, its path's first ``depth`` segments with digits as one kind,
its scheme and its query's names. What hangs on a later segment is not seen.

FP-growth is fitted on ``sample_rows`` labelled urls at most, those with the smallest hashes. A learned rule has at most
``max_tokens`` tokens, so their number is bounded by the sample. Every url is judged.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is judged by its tokens
(none: ``default``); repeated rows are judged each on its own; extra columns are kept by ``judge``.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm import common

# The given rules, (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    before = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(before, r"^([^/]*)", 1)
    path = F.substring(before, F.char_length(host) + 1, F.char_length(before))
    return F.translate(host, common.UPPER, common.LOWER), path


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def by_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule; the given rules are few and become one expression."""
    kind = "struct<rule:string,verdict:string>"
    told = F.lit(None).cast(kind)
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0], r[1])):
        answer = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")).cast(kind)
        told = F.when(fits(host, path, rule_host, rule_path), answer).otherwise(told)
    return told


def tokens(url: Column, host: Column, path: Column, depth: int = 2) -> Column:
    """Distinct tokens of a url, null for none."""
    labels = F.filter(F.split(F.regexp_replace(host, r":\d*$", ""), r"\."), lambda x: x != "")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(3), F.size(labels)))),
        lambda n: F.concat(F.lit("host="), F.array_join(F.slice(labels, -n, n), ".")),
    )
    subdomain = F.when(F.size(labels) > 2, F.array(F.concat(F.lit("sub="), labels[0]))).otherwise(F.array().cast("array<string>"))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    first = F.transform(F.slice(segments, 1, depth), lambda x, i: F.concat(F.lit("path"), i, F.lit("="), F.lower(F.regexp_replace(x, r"\d+", "9"))))
    query = F.transform(
        F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query="), F.regexp_extract(x, r"^([^=]*)", 1)),
    )
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"^([^:]*)://", 1))))
    every = F.array_distinct(F.concat(suffixes, subdomain, first, query, scheme))
    return F.when(F.size(labels) > 0, every).otherwise(F.array().cast("array<string>"))


def learn(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.8, max_tokens: int = 3, sample_rows: int = 20_000) -> DataFrame:
    """(rule_id, tokens, label, confidence, support) from rows of (tokens, label, order).

    ``order`` (a hash of the url) picks the sample: its ``sample_rows`` smallest rows, or all if there are fewer.
    """
    kept = labelled.where(F.size("tokens") > 0).select("tokens", "label", "order").orderBy("order", "label").limit(sample_rows)
    items = kept.select(F.concat("tokens", F.array(F.concat(F.lit("label="), "label"))).alias("items"))
    mined = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items).associationRules
    rules = common.saved(
        mined.where((F.size("antecedent") <= max_tokens) & F.startswith(F.col("consequent")[0], F.lit("label=")))
        .where(F.size(F.filter("antecedent", lambda x: F.startswith(x, F.lit("label=")))) == 0)
        .select(F.sort_array("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 7, 1000).alias("label"), "confidence", "support")
    )
    # A rule stays if no part of it with one token less says as much: parts are looked up by their tokens.
    parts = rules.where(F.size("tokens") > 1).select(
        F.col("tokens").alias("whole"), "label", F.col("confidence").alias("of_whole"), F.explode("tokens").alias("without")
    )
    parts = parts.withColumn("tokens", F.array_remove("whole", F.col("without")))
    idle = parts.join(rules.select("tokens", "label", "confidence"), ["tokens", "label"]).where("confidence >= of_whole")
    kept = rules.join(idle.select(F.col("whole").alias("tokens"), "label").distinct(), ["tokens", "label"], "left_anti")
    return kept.withColumn("rule_id", F.xxhash64("tokens", "label"))


def index(rules: DataFrame) -> DataFrame:
    """The inverted index: each rule under its rarest token among all rules."""
    listed = rules.select("rule_id", F.explode("tokens").alias("token"))
    counts = listed.groupBy("token").agg(F.count("*").alias("n"))
    rarest = listed.join(counts, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("t"))
    return rules.join(rarest, "rule_id").select(F.col("t.token").alias("token"), "rule_id", "tokens", "label", "confidence", "support")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow", **how) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, and ``learned`` (the tokens of the learned rule, if one decided)."""
    if default not in ("allow", "block"):
        raise ValueError("default must be allow or block")
    clash = {"host", "path", "rule", "verdict", "learned", "tokens"} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    base = pages.select("*", host.alias("host"), path.alias("path"))
    given = by_rules(F.col("host"), F.col("path"), rules)
    base = base.select(
        "*",
        given.alias("_given"),
        tokens(F.coalesce("url", F.lit("")), F.col("host"), F.col("path")).alias("_tokens"),
    )
    labelled = base.where("_given IS NOT NULL").select(
        F.col("_tokens").alias("tokens"), F.col("_given.verdict").alias("label"), F.xxhash64("url").alias("order")
    )
    learned = index(learn(labelled, **how))
    # Urls with the same tokens are judged once. Rows that a given rule decides, or that have no token, meet nothing; the
    # others meet their verdict by a key of its own, so that a token set that very many share can be split.
    open_rows = base.where("_given IS NULL AND size(_tokens) > 0").withColumn("tokens", F.sort_array("_tokens"))
    sets = open_rows.select("tokens").distinct()
    rows = sets.select("tokens", F.explode("tokens").alias("token"))
    found = rows.join(learned.withColumnRenamed("tokens", "needs"), "token").where(F.size(F.array_except("needs", "tokens")) == 0)
    best = F.max(F.struct("confidence", F.size("needs"), "support", (F.col("label") == "block"), "label", "needs")).alias("b")
    verdicts = found.groupBy("tokens").agg(best).select("tokens", F.col("b.label").alias("_label"), F.col("b.needs").alias("learned"))
    salted = F.xxhash64("tokens").alias("_salted")
    met = open_rows.select("*", salted).join(verdicts.select("*", salted), ["_salted", "tokens"], "left")
    shown = [*pages.columns, "host", "path", "_given", "_label", "learned"]
    rest = base.where("_given IS NOT NULL OR size(_tokens) = 0")
    rest = rest.withColumns({"_label": F.lit(None).cast("string"), "learned": F.lit(None).cast("array<string>")})
    told = met.select(*shown).unionByName(rest.select(*shown))
    return told.select(
        *pages.columns,
        "host",
        "path",
        F.col("_given.rule").alias("rule"),
        F.coalesce("_given.verdict", "_label", F.lit(default)).alias("verdict"),
        "learned",
    )
