"""Merkle manifest of a dataset: one leaf a row, a tree for each language, a root over them.

Every row is a leaf, the SHA-256 of its fields with their lengths. The leaves of one language
stand in the order of ``doc_id``; pairs of neighbours are hashed until one node is left, and the
languages' nodes make a tree in the same way.

A tree is cut into aligned blocks of 256 nodes. A block keeps each of its levels as one string
of hex digests: fixed-width substrings of a level are hashed to the level above, and the
substring beside a node is its sibling. The tops of the blocks are the nodes of the next round,
so a tree of any size takes a few rounds of small blocks, and one language may hold all rows.

Defined cases: a null field enters as ``-``, an empty one as ``0:``, so the two differ. Rows of a
null language form a tree of their own, before the others. A null ``doc_id`` comes first in its
language. Rows of one ``doc_id`` stand in the order of their digests; rows that are equal in all
five fields are leaves each, and which of them comes first makes no difference to the result as
a whole. Texts enter whole, of any length. Other columns are ignored, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored
from sparkdraft.llm.numbering import numbered

#: Levels of a block: it holds 2 ** LEVELS nodes.
LEVELS = 8
#: Hex digits of a digest.
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(F.concat(*[field(f) for f in fields]))


def depth(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves: the binary digits of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def node(level: Column, i: Column) -> Column:
    """Digest i of a level; empty beyond its end."""
    return F.substring(level, (i * WIDTH + 1).cast("int"), F.lit(WIDTH))


def parents(level: Column) -> Column:
    """The level above: each run of two digests, the last one perhaps alone, hashed."""
    last = F.ceil(F.length(level) / (2 * WIDTH)).cast("int") - 1
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: digest(
        F.substring(level, i * (2 * WIDTH) + 1, F.lit(2 * WIDTH)))), "")


def levels(lowest: Column, height: Column) -> Column:
    """The level strings of a block, the lowest first and ``height`` more."""
    return F.when(height > 0, F.aggregate(
        F.sequence(F.lit(1), height), F.array(lowest),
        lambda done, _: F.concat(done, F.array(parents(F.element_at(done, -1)))),
    )).otherwise(F.array(lowest))


def siblings(block: Column, i: Column) -> Column:
    """For node i of a block's lowest level: the node beside it on every level but the top."""
    def beside(level: Column, up: Column) -> Column:
        at = F.floor(i / F.pow(F.lit(2.0), up)).cast("int")
        return node(level, at.bitwiseXOR(F.lit(1)))

    return F.transform(F.slice(block, F.lit(1), F.size(block) - 1), beside)


def folded(start: Column, position: Column, path: Column) -> Column:
    """The top of a tree from one node, its position and its siblings, the lowest first."""
    first = F.struct(start.alias("node"), position.cast("long").alias("at"))

    def step(below: Column, sibling: Column) -> Column:
        right = below["at"] % 2 == 1
        return F.struct(
            digest(F.when(right, F.concat(sibling, below["node"]))
                   .otherwise(F.concat(below["node"], sibling))).alias("node"),
            F.shiftright(below["at"], 1).alias("at"))

    return F.aggregate(path, first, step, lambda top: top["node"])


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of (tree, i, n, node, load): level strings, and the loads in order."""
    cut = nodes.select(
        "tree", "n", F.shiftright("i", LEVELS).alias("block"),
        F.struct(F.col("i").bitwiseAND((1 << LEVELS) - 1).alias("at"), "node", "load").alias("e"))
    rows = cut.groupBy("tree", "n", "block").agg(F.array_sort(F.collect_list("e")).alias("e"))
    height = F.least(depth(F.col("n")), F.lit(LEVELS))
    return rows.select(
        "tree", "n", "block", F.transform("e", lambda e: e["load"]).alias("loads"),
        levels(F.array_join(F.transform("e", lambda e: e["node"]), ""), height).alias("levels"))


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """A row for each node of the blocks: its load, and its siblings up to its tree's top.

    ``above`` has the siblings of each block's top, as (tree, block, path, top)."""
    rows = blocks.join(above, ["tree", "block"])

    def entry(load: Column, at: Column) -> Column:
        return F.struct(load.alias("load"),
                        (F.shiftleft(F.col("block"), LEVELS) + at).alias("i"),
                        F.concat(siblings(F.col("levels"), at), F.col("path")).alias("path"))

    return rows.select("tree", "top", F.explode(F.transform("loads", entry)).alias("e")) \
        .select("tree", "top", "e.load", "e.i", "e.path")


def forest(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(rounds, tops) of the trees of (tree, i, n, node, load).

    ``i`` numbers a tree's ``n`` nodes from 0. Each round is a table of blocks, which hold at
    most 256 nodes; ``tops`` has one row (tree, node) a tree.
    """
    rounds = []
    while True:
        blocks = stored(_blocks(nodes), "merkle-blocks")
        rounds.append(blocks)
        tops = blocks.select("tree", F.element_at("levels", -1).alias("node"))
        if blocks.where(F.col("block") > 0).isEmpty():
            return rounds, tops
        nodes = blocks.select(
            "tree", F.col("block").alias("i"),
            F.shiftright(F.col("n") + ((1 << LEVELS) - 1), LEVELS).alias("n"),
            F.element_at("levels", -1).alias("node"), F.lit(None).cast("int").alias("load"))


def proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, top, load, i, path) of every node that the first round held."""
    no_path = F.array().cast("array<string>")
    above = tops.select("tree", F.lit(0).cast("long").alias("block"), no_path.alias("path"),
                        F.col("node").alias("top"))
    for blocks in reversed(rounds[1:]):
        above = _paths(blocks, above).select("tree", F.col("i").alias("block"), "path", "top")
    return _paths(rounds[0], above)


def leaves(documents: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered): ``tree`` sorts as the languages do, null first;
    ``tampered`` is the leaf of the altered row, null where the row is not altered."""
    own = [F.col(f) for f in FIELDS]
    altered = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return documents.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf(own).alias("leaf"),
        F.when(hit, leaf(altered)).alias("tampered"))


def manifest(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = numbered(stored(leaves(documents), "merkle-leaves"), ["tree"], ["doc_id", "leaf"])
    rounds, tops = forest(rows.select(
        "tree", F.col("llm_i").alias("i"), F.col("llm_n").alias("n"), F.col("leaf").alias("node"),
        F.struct("doc_id", "leaf", "tampered").alias("load")))
    trees = numbered(stored(tops.select(F.lit(0).alias("all"), "tree", "node"), "merkle-tops"),
                     ["all"], ["tree"])
    upper, root = forest(trees.select(
        F.lit("").alias("tree"), F.col("llm_i").alias("i"), F.col("llm_n").alias("n"), "node",
        F.struct("tree", "node").alias("load")))
    # One row a language: its place among them, its top, the siblings above and the root.
    languages = proofs(upper, root).select(
        F.col("load.tree").alias("tree"), F.struct(
            F.col("i"), F.col("load.node").alias("node"), "path", F.col("top").alias("root"),
        ).alias("node"))
    found = proofs(rounds, languages).select(
        F.col("load.doc_id").alias("doc_id"), F.col("load.leaf").alias("leaf"),
        F.col("top.node").alias("subroot"), F.col("top.root").alias("root"),
        digest(F.concat(F.array_join("path", ""), F.array_join("top.path", ""))).alias("proof_sha256"),
        folded(folded(F.coalesce("load.tampered", "load.leaf"), F.col("i"), F.col("path")),
               F.col("top.i"), F.col("top.path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
