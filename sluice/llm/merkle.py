"""Merkle manifest of a document table, proofs by butterfly exchange.

Each row is a leaf: the digest of its columns. Per source the leaves ascend by doc_id, and every ``FANOUT``
consecutive nodes become their digest until one node, the subroot, is left; the subroots, ordered by source,
likewise give the root. A leaf's proof are the siblings on its way to the root.

Leaves get their place by a range sort and the row counts of its partitions. A block of ``FANOUT ** BLOCK_LEVELS``
consecutive leaves of a source is hashed to its own root in one task. Then the blocks go on as in a butterfly
network: in each round the subtrees of an aligned group of ``FANOUT`` swap roots, member l of one subtree with
member l of every other, so that each block receives its at most ``FANOUT`` sibling roots, hashes their parent
itself (the same parent is hashed by every block below it) and appends the siblings to its proof. Where subtrees
have different numbers of blocks, the smaller one's members answer for several places. After the last round of the
sources' trees the rounds go on over the sources. Every block then holds the root and its whole upper proof, and
nothing is sent back down; its leaves' proofs are that one after the siblings within the block.

Bounds. A task holds one block (4,096 leaves of three digests) or one swap of at most ``FANOUT`` rows, whatever the
source; the driver gets the number of rounds. Texts are read once and do not leave the scan: rows carry digests.

Defined results. A null column counts as ``-``, an empty text as ``0:``. Null ids sort first, null sources too;
rows with the same id ascend by their leaf digest, so repeated rows are leaves side by side. A tree of one leaf has
that leaf as its root, and the proof of no siblings is the digest of the empty string. An empty table has no rows.
Columns besides doc_id, source, lang, n_chars and text are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.tables import staged, table

FANOUT = 16
BLOCK_LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many is tampered with, by the crc32 of its id.
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return _digest(*(_field(text if c == "text" else F.col(c)) for c in COLUMNS))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _placed(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` with ``place``, its position in the order of ``by`` from 0: rows are range-partitioned and sorted,
    and each one's place in its partition is added to the sizes of the partitions before (one row each)."""
    spread = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("part", F.spark_partition_id())
              .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    spread = staged(spread, name)
    sizes = spread.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return spread.join(before, "part").withColumn("place", F.col("at") + F.col("before")).drop("part", "at", "before")


def _levels(n: Column, fanout: int) -> Column:
    """Levels above ``n`` nodes until one is left."""
    most, powers = 63, []
    while fanout ** len(powers) < 1 << most:
        powers.append(fanout ** len(powers))
    return sum((F.when(n > p, 1).otherwise(0) for p in powers), F.lit(0))


def _climb(nodes: list[str], levels: int, fanout: int) -> tuple[list[list[str]], str]:
    """The nodes of each level below the top, and the top one."""
    kept = []
    for _ in range(levels):
        kept.append(nodes)
        nodes = [_hash("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return kept, nodes[0]


def _swap(state: DataFrame, scope: list[str], fanout: int) -> DataFrame:
    """One round. A row is a block: member ``member`` of the ``members`` blocks below node ``node`` (one of
    ``nodes`` of its tree), with the node's digest ``root``."""
    state = state.withColumn("group_", F.col("node") - F.col("node") % fanout)
    widths = state.groupBy(*scope, "group_").agg(F.max("members").alias("width"))
    sent = (state.join(widths, [*scope, "group_"])
            .withColumn("to", F.explode(F.sequence(F.col("member"), F.col("width") - 1, F.col("members")))))
    own = [c for c in state.columns if c not in (*scope, "group_")]
    met = (sent.groupBy(*scope, "group_", "to")
           .agg(F.sort_array(F.collect_list(F.struct(
               "node", "members", "root", F.when(F.col("to") == F.col("member"), F.struct(*own)).alias("me")))).alias("all"))
           .withColumn("parent", F.sha2(F.concat_ws("", "all.root"), 256))
           .withColumn("total", F.aggregate("all.members", F.lit(0).cast("long"), lambda a, m: a + m)))
    each = met.select(*scope, "group_", "all", "parent", "total", F.explode("all").alias("x")).where("x.me is not null")
    before, after = (F.filter("all", lambda y: y["node"] < F.col("x.node")),
                     F.filter("all", lambda y: y["node"] > F.col("x.node")))
    lower, higher = (F.concat_ws("", F.transform(some, lambda y: y["root"])) for some in (before, after))
    offset = F.aggregate(before, F.lit(0).cast("long"), lambda a, y: a + y["members"])
    alone = F.col("x.me.nodes") <= 1  # a tree of one node is complete
    moved = {
        "node": F.expr(f"group_ div {fanout}"), "nodes": F.expr(f"(x.me.nodes + {fanout - 1}) div {fanout}"),
        "member": F.when(alone, F.col("x.me.member")).otherwise(F.col("x.me.member") + offset),
        "members": F.when(alone, F.col("x.me.members")).otherwise(F.col("total")),
        "root": F.when(alone, F.col("x.me.root")).otherwise(F.col("parent")),
        "proof": F.when(alone, F.col("x.me.proof")).otherwise(F.concat(
            "x.me.proof", F.array(F.struct(lower.alias("lower"), higher.alias("higher"))))),
    }
    kinds = dict(state.dtypes)
    return each.select(*scope, *(moved.get(c, F.col(f"x.me.{c}")).cast(kinds[c]).alias(c) for c in own))


def _rounds(state: DataFrame, scope: list[str], fanout: int) -> DataFrame:
    most = state.agg(F.max("nodes")).first()[0] or 0
    step = 0
    while most > 1:
        state = staged(_swap(state, scope, fanout), f"merkle-round-{step}")
        most, step = -(-most // fanout), step + 1
    return state


def manifest(documents: DataFrame, tampered_text: Column, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the leaf of ``tampered_text`` and the siblings
    of the original tree) and verified of each row of ``documents``."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    block = fanout ** block_levels
    changed = ~tampered_text.eqNullSafe(F.col("text"))
    leaves = staged(documents.select(*COLUMNS).select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_"),
        leaf_digest(F.col("text")).alias("leaf"),
        F.when(changed, leaf_digest(tampered_text)).alias("tampered")), "merkle-leaves")
    leaves = staged(_placed(leaves, ["source_", "doc_id", "leaf"], "merkle-sorted"), "merkle-placed")
    sources = leaves.groupBy("source_").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # an unchanged rank of each source, and how many levels its tree has
    sources = staged(_placed(sources, ["source_"], "merkle-sources").withColumnRenamed("place", "tree")
                     .withColumn("levels", _levels(F.col("n"), fanout)), "merkle-trees")
    trees = sources.count()
    leaves = staged(leaves.join(sources, "source_").withColumn("rank", F.col("place") - F.col("first")).select(
        "tree", F.expr(f"rank div {block}").alias("block"), "rank", "doc_id", "leaf", "tampered",
        F.least("levels", F.lit(block_levels)).cast("int").alias("inner"),
        F.expr(f"(n + {block - 1}) div {block}").alias("blocks")), "merkle-blocks")

    def ordered(group: pa.Table) -> dict[str, list]:
        return group.sort_by("rank").to_pydict()

    def block_root(group: pa.Table) -> pa.Table:
        rows = ordered(group)
        _, top = _climb(rows["leaf"], rows["inner"][0], fanout)
        return pa.table({"tree": pa.array(rows["tree"][:1], pa.int64()), "block": pa.array(rows["block"][:1], pa.int64()),
                         "nodes": pa.array(rows["blocks"][:1], pa.int64()), "root": [top]})

    none = F.array().cast("array<struct<lower: string, higher: string>>")
    state = (leaves.groupBy("tree", "block").applyInArrow(block_root, "tree long, block long, nodes long, root string")
             .select("tree", "block", F.col("block").alias("node"), "nodes", F.lit(0).cast("long").alias("member"),
                     F.lit(1).cast("long").alias("members"), "root", none.alias("proof")))
    state = _rounds(staged(state, "merkle-roots"), ["tree"], fanout)
    state = (state.withColumn("subroot", F.col("root")).withColumn("node", F.col("tree"))
             .withColumn("nodes", F.lit(trees).cast("long")))
    upper = _rounds(state, [], fanout).select("tree", "block", "subroot", "root", "proof")

    def prove(key, group: pa.Table, above: pa.Table) -> pa.Table:
        rows, top = ordered(group), above.to_pylist()[0]
        kept, _ = _climb(rows["leaf"], rows["inner"][0], fanout)
        out = {"proof_sha256": [], "folded_root": []}
        above_text = "".join(p["lower"] + p["higher"] for p in top["proof"])
        for i, (leaf, tampered) in enumerate(zip(rows["leaf"], rows["tampered"], strict=True)):
            node, siblings = tampered or leaf, []
            for nodes in kept:
                first = i - i % fanout
                lower, higher = "".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])
                siblings += [lower, higher]
                node, i = _hash(lower + node + higher), i // fanout
            for p in top["proof"]:
                node = _hash(p["lower"] + node + p["higher"])
            out["proof_sha256"].append(_hash("".join(siblings) + above_text))
            out["folded_root"].append(node)
        n = len(rows["leaf"])
        table_ = group.sort_by("rank")
        return pa.table({"doc_id": table_.column("doc_id"), "leaf": rows["leaf"], "subroot": [top["subroot"]] * n,
                         "root": [top["root"]] * n, **out,
                         "verified": [x == top["root"] for x in out["folded_root"]]})

    return (leaves.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
            .applyInArrow(prove, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean"))


def lowered(text: Column, where: Column) -> Column:
    """``text`` with A-Z lower-cased where the condition holds."""
    return F.when(where, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    picked = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return manifest(docs, lowered(F.col("text"), picked))


def oracle(levels: int = 8) -> str:
    """The same in DuckDB, for trees of up to ``levels`` levels."""
    def field(c, text):
        v = text if c == "text" else f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(c, text) for c in COLUMNS) + ")"

    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    parts = [f"""crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN xor(4294967295, list_reduce(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i:
                ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1))),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) % {TAMPERED} = 0
              THEN {leaf(lower)} ELSE {leaf('text')} END AS tampered
  FROM documents, crc_table),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves)"""]

    def climb(prefix, first):
        """Levels of one forest: (tree, place, node) of each level, whose lone nodes stay."""
        at = [f"{prefix}0 AS ({first})"]
        for k in range(levels):
            at.append(f"""{prefix}{k}n AS (SELECT tree, count(*) AS nodes FROM {prefix}{k} GROUP BY tree)""")
            at.append(f"""{prefix}{k + 1} AS (
  SELECT a.tree, CASE WHEN nodes = 1 THEN place ELSE place // {FANOUT} END AS place,
         CASE WHEN min(nodes) = 1 THEN min(node) ELSE sha256(string_agg(node, '' ORDER BY a.place)) END AS node
  FROM {prefix}{k} a JOIN {prefix}{k}n n ON n.tree = a.tree
  GROUP BY a.tree, CASE WHEN nodes = 1 THEN place ELSE place // {FANOUT} END)""")
        return at

    def paths(prefix, base):
        """The siblings of every level, as texts before and after, of each row (tree, place) of ``base``."""
        at, last = [], base
        for k in range(levels):
            at.append(f"""{prefix}p{k} AS (
  SELECT p.id, p.tree, p.place // {FANOUT} AS place, p.proof || coalesce(s.lower_, '') || coalesce(s.higher, '') AS proof,
         CASE WHEN s.nodes = 1 THEN p.folded ELSE sha256(coalesce(s.lower_, '') || p.folded || coalesce(s.higher, '')) END AS folded
  FROM {last} p JOIN (
    SELECT a.tree, a.place, min(n.nodes) AS nodes, string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place) AS lower_,
           string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place) AS higher
    FROM {prefix}{k} a JOIN {prefix}{k}n n ON n.tree = a.tree
    JOIN {prefix}{k} b ON b.tree = a.tree AND b.place // {FANOUT} = a.place // {FANOUT}
    GROUP BY a.tree, a.place) s ON s.tree = p.tree AND s.place = p.place)""")
            last = f"{prefix}p{k}"
        return at, last

    parts += climb("l", "SELECT tree, place, leaf AS node FROM ranked")
    parts += climb("s", f"SELECT 0 AS tree, tree AS place, node FROM l{levels}")
    parts.append("start AS (SELECT id, tree, place, '' AS proof, tampered AS folded FROM ranked)")
    inner, last = paths("l", "start")
    parts += inner
    parts.append(f"between_ AS (SELECT p.id, 0 AS tree, r.tree AS place, p.proof, p.folded FROM {last} p JOIN ranked r ON r.id = p.id)")
    outer, last = paths("s", "between_")
    parts += outer
    return "WITH " + ",\n".join(parts) + f"""
SELECT r.doc_id, r.leaf, l.node AS subroot, s.node AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root,
       p.folded = s.node AS verified
FROM ranked r JOIN l{levels} l ON l.tree = r.tree JOIN {last} p ON p.id = r.id CROSS JOIN s{levels} s"""


ORACLE = oracle()
