"""The trie of conversation prefixes, by collapsing whole sequences.

Every conversation is rebuilt: it opens with the first h turns of the conversation that heads its ``family`` (c - c % family), and
goes on with its own turns after its first h, where h = crc32(c) % ``heads``. Then

1. identical rebuilt conversations become one weighted sequence with the list of the conversations that end there;
2. sequences that are a proper prefix of another go by an anti join, which leaves the leaves;
3. the prefixes of the weighted sequences are summed up per node. A sequence's copies are never expanded.

What a subtree saves is the sum of (members - 1) * size over its nodes. It is taken from the sequences that pass through
its top, without walking the tree: members * size adds up to weight * what is left of each sequence, and each node's size is
counted by its owner, the sequence with the smallest conversation, which owns its own path from some depth to its end.

Only narrow rows are shuffled, never texts. A prefix is told by the exclusive or of 128-bit hashes of (depth, role, text)
of its turns. Lists of ends are formed in groups of 4,096 neighbouring ids and hashed as a stream, so no list is ever whole in
memory. Sums per node and label are added up before every shuffle; the join of nodes with a parent that very many share has
shuffles of its own that Spark can split. A family is at most 2 * ``family`` conversations; turns of one are numbered by a
window that spills.

Defined results: turns without conv_id belong to no conversation; a null role or text is empty; turns are ordered by turn, null
first, then role, then a hash of the text; repeated rows are turns of their own. % keeps the sign of its left side, so
conversations from -99 to 99 share the head 0. No rows give no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretide.llm import common

#: Ids that share all but their last twelve bits are listed together.
GROUP_BITS = 12


def numbered(conversations: DataFrame, family: int = 100) -> DataFrame:
    """family, conv_id, pos, role, text and the turn's hashes (a, b) and size in code points; a family's rows lie together."""
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    rows = rows.withColumns(
        {
            "family": F.col("conv_id") - F.col("conv_id") % family,
            "a": F.xxhash64(F.lit(1), "role", "text"),
            "b": F.xxhash64(F.lit(2), "role", "text"),
            "size": F.char_length("text"),
        }
    )
    return rows


def _placed(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("family", "conv_id").orderBy(F.asc_nulls_first("turn"), "role", "a", "b")
    return rows.repartition("family").withColumn("pos", F.row_number().over(order))


def rebuilt(conversations: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """conv_id, depth, a, b, size and the place each turn was taken from, with a textless row of depth 0 for every conversation."""
    rows = _placed(numbered(conversations, family).drop("text"))
    turn = F.struct("pos", "a", "b", "size")
    leads = (F.col("conv_id") == F.col("family")) & (F.col("pos") < heads)
    head = F.array_sort(F.collect_list(F.when(leads, turn)).over(Window.partitionBy("family")))  # fewer than ``heads`` turns
    rows = rows.withColumns({"head": head, "h": (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")})

    def piece(depth: Column, a: Column, b: Column, size: Column, source: Column, pos: Column) -> Column:
        parts = {"depth": depth, "a": a, "b": b, "size": size, "source": source, "pos": pos}
        return F.struct(*(v.cast("long").alias(k) for k, v in parts.items()))

    zero, here, taken = F.lit(0), F.col("conv_id"), F.slice("head", F.lit(1), F.col("h"))
    opening = F.transform(taken, lambda x: piece(x.pos, x.a, x.b, x.size, F.col("family"), x.pos))
    opening = F.concat(F.array(piece(zero, zero, zero, zero, here, zero)), opening)
    own = F.array(piece(F.least("h", F.size("head")) + F.col("pos") - F.col("h"), F.col("a"), F.col("b"), F.col("size"), here, F.col("pos")))
    none = F.slice(own, 1, 0)
    pieces = F.concat(F.when(F.col("pos") == 1, opening).otherwise(none), F.when(F.col("pos") > F.col("h"), own).otherwise(none))
    return rows.select("family", "conv_id", F.explode(pieces).alias("t")).select("family", "conv_id", "t.*")


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: depth, its id (x, y), its parent's (px, py), its last turn's size, the sum of sizes so far
    (reach), and whether the conversation ends there."""
    path = Window.partitionBy("family", "conv_id").orderBy("depth")
    steps = {s: F.when(F.col("depth") > 0, F.xxhash64(F.lit(k), "depth", "a", "b")).otherwise(F.lit(0)) for k, s in enumerate(("sx", "sy"))}
    told = turns.withColumns(steps).withColumns(
        {
            "x": F.bit_xor("sx").over(path),
            "y": F.bit_xor("sy").over(path),
            "reach": F.sum("size").over(path),
            "ends": F.lead("depth").over(path).isNull(),
        }
    )
    px, py = F.col("x").bitwiseXOR(F.col("sx")).alias("px"), F.col("y").bitwiseXOR(F.col("sy")).alias("py")
    return told.select("conv_id", "depth", "x", "y", px, py, "size", "reach", "ends", "source", "pos")


@dataclass(frozen=True)
class Trie:
    """Stored tables. ``paths``: the prefixes of all conversations; ``ends``: per sequence (x, y) the conversations that end there,
    ascending, in groups; ``sequences``: first (smallest conversation), weight, last (depth) and total (size) of each;
    ``leaves``: those that are no proper prefix; ``nodes``: one row per prefix."""

    paths: DataFrame
    ends: DataFrame
    sequences: DataFrame
    leaves: DataFrame
    nodes: DataFrame

    def leaf_turns(self, conversations: DataFrame, family: int = 100) -> DataFrame:
        """conv_id, weight, depth, role, text of the leaves: what is left to train on, each sequence once."""
        wanted = self.leaves.select(F.col("first").alias("conv_id"), "weight")
        places = self.paths.where("depth > 0").join(wanted, "conv_id").select("conv_id", "weight", "depth", "source", "pos")
        texts = _placed(numbered(conversations, family)).select(F.col("conv_id").alias("source"), F.col("pos").cast("long").alias("pos"), "role", "text")
        return places.join(texts, ["source", "pos"]).select("conv_id", "weight", "depth", "role", "text")

    def digests(self) -> DataFrame:
        """x, y and the SHA-256 of the sequence's ends, comma-joined."""
        listed = self.ends.select("x", "y", "part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
        return listed.repartition("x", "y").sortWithinPartitions("x", "y", "part").mapInArrow(_digests, "x long, y long, ends_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]):
    """Groups of one sequence stand together and in order, maybe over several batches."""
    key, hasher, done = None, None, []
    for batch in batches:
        for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids"))):
            if (x, y) == key:
                hasher.update(b"," + ids.encode())
            else:
                if key:
                    done.append((*key, hasher.hexdigest()))
                key, hasher = (x, y), hashlib.sha256(ids.encode())
        if done:
            yield _told(done)
            done = []
    if key:
        yield _told([(*key, hasher.hexdigest())])


def _told(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    x, y, sha = zip(*rows)
    return pa.RecordBatch.from_pydict({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()), "ends_sha256": pa.array(sha)})


def collapse(conversations: DataFrame, family: int = 100, heads: int = 6) -> Trie:
    """The trie of the rebuilt conversations."""
    common.importable(conversations.sparkSession)
    paths = common.saved(prefixes(rebuilt(conversations, family, heads)))
    final = paths.where("ends").withColumn("part", F.shiftright("conv_id", GROUP_BITS))
    ends = common.saved(
        final.groupBy("x", "y", "part").agg(  # at most 4,096 ids
            F.array_sort(F.collect_list("conv_id")).alias("ids"), F.max("depth").alias("last"), F.max("reach").alias("total")
        )
    )
    sequences = common.saved(
        ends.groupBy("x", "y").agg(
            F.min(F.element_at("ids", 1)).alias("first"),
            F.sum(F.size("ids")).alias("weight"),
            F.max("last").alias("last"),
            F.max("total").alias("total"),
        )
    )
    of = sequences.select(F.col("first").alias("conv_id"), "weight", "last", "total")
    weighted = common.saved(paths.drop("ends", "source", "pos").join(of, "conv_id"))
    inner = weighted.where("depth < last").select("x", "y").distinct()
    leaves = common.saved(sequences.join(inner, ["x", "y"], "left_anti"))
    nodes = common.saved(_nodes(weighted, leaves))
    return Trie(paths, ends, sequences, leaves, nodes)


def _nodes(weighted: DataFrame, leaves: DataFrame) -> DataFrame:
    """x, y, px, py, conv_id (smallest member), depth, n_convs, n_leaves, saved_tokens."""
    node = ["x", "y"]
    before = F.col("reach") - F.col("size")
    # What every sequence that passes through the node has in common, and the node's owner.
    whole = weighted.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), *(F.max(c).alias(c) for c in ("depth", "px", "py", "size", "reach")), F.sum("weight").alias("n_convs")
    )
    whole = common.saved(whole)
    owned = whole.groupBy("conv_id").agg(F.min(before).alias("own_from"))
    traits = owned.join(leaves.select(F.col("first").alias("conv_id"), F.lit(1).alias("leaf")), "conv_id", "full")
    through = weighted.join(traits, "conv_id", "left")
    # A sequence that owns nothing is a proper prefix of one with a smaller conversation.
    own_size = F.when(F.col("own_from").isNotNull(), F.col("total") - F.greatest(before, "own_from")).otherwise(F.lit(0))
    sums = through.groupBy(*node).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - before) - own_size).alias("saved_tokens"),
    )
    return whole.drop("size", "reach").join(sums, node)


def node_report(conversations: DataFrame, **how) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    trie = collapse(conversations, **how)
    node = ["x", "y"]
    # Grouped apart from the join below: a parent of very many is counted by partial sums.
    children = trie.nodes.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    parents = trie.nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    parents = parents.withColumn("above", F.lit(True))
    below = trie.nodes.withColumn("above", F.col("depth") > 0)  # the root is its own parent by its hashes
    told = below.join(parents, ["px", "py", "above"], "left")
    told = told.join(children, node, "left").join(trie.digests(), node, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return told.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


#: The result in SQL: prefixes as lists, every node under each of its ancestors.
REPORT_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END, 4294967295::BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, t.pos AS depth, role, text FROM c JOIN t ON t.conv_id = head AND pos <= h
  UNION ALL
  SELECT c.conv_id, least(h, coalesce(n, 0)) + pos - h, role, text
  FROM c JOIN t USING (conv_id) LEFT JOIN (SELECT conv_id AS head, count(*) AS n FROM t GROUP BY ALL) USING (head) WHERE pos > h
), s AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY depth) FILTER (depth IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id
), n AS MATERIALIZED (
  SELECT turns[1:d] AS node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs
  FROM s, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d) GROUP BY ALL
), k AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), u AS (
  SELECT node[1:d] AS node, count(*) FILTER (n_children IS NULL) AS n_leaves,
    sum((n_convs - 1) * coalesce(length(node[depth].text), 0)) AS saved_tokens
  FROM (SELECT * FROM n LEFT JOIN k USING (node)) n, LATERAL (SELECT unnest(range(depth + 1)) AS d) GROUP BY ALL
), e AS (
  SELECT turns AS node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM s GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN u USING (node) LEFT JOIN k USING (node) LEFT JOIN e USING (node)
LEFT JOIN n p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""
