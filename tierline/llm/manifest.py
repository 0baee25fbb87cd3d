"""A Merkle manifest of a dataset, with versions by path copying (operator 13).

A leaf is the digest of a row. The leaves of a source stand in the order of
their ids; every three consecutive nodes (the last run may be shorter, even one
node) become one node until one is left, the source's root. The sources' roots,
in the order of the sources, form the tree above, up to the dataset's root.

Plan.

1. One pass over the texts writes ``(doc_id, source, leaf, tampered leaf)``;
   later steps read only that narrow table.
2. Positions: the leaves are sorted by range of (source, doc_id, leaf), numbered
   within their partition, and a small table of (partition, source) counts gives
   every partition's offset. No task holds a source.
3. Blocks of ``3**HEIGHT`` leaves, aligned to the tree, each become one node in
   one task; blocks of those nodes the next, until every source has its root;
   the same for the sources' roots. Every round also keeps the path of each
   block: the digests left and right of it, level by level.
4. Versions: within its block a tampered leaf makes a version of the tree. It
   shares all nodes with the original but its own ancestors, which are copied;
   above the block the version goes on along the block's stored path, so no
   task ever holds more than one block and the versions that begin in it.

Defined results: a null field enters a leaf as ``-``; a null source is a source
of its own, before all others; a null id stands first and hashes as the empty
text when rows are chosen for tampering; rows that tie on the id follow their
leaf digest, fully equal rows are interchangeable and each has a place of its
own; a row without a text, or whose text has no line end, keeps its leaf when
tampered with; an empty table gives no rows. Columns other than the fields are
not read. A text is hashed by the task that reads it, whatever its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import id_fold, shuffle_parts, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
HEIGHT = 8              # levels of a block: 3**8 = 6,561 leaves
TOP_TREE = "sources"    # names the tree above the sources' trees


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as it enters a leaf: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


# ---- one block -------------------------------------------------------------------------
class Block:
    """The nodes of an aligned block, level by level; never changed."""

    def __init__(self, leaves: list[str], levels: int):
        self.nodes = [leaves]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append([digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def root(self) -> str:
        return self.nodes[-1][0]

    def siblings(self, position: int) -> list[tuple[str, str]]:
        """(digests left, digests right) of the path's node in its run, from
        the leaf's level to the one below the root."""
        out = []
        for level in self.nodes[:-1]:
            first = position - position % FAN
            out.append(("".join(level[first:position]), "".join(level[position + 1:first + FAN])))
            position //= FAN
        return out


class Version:
    """The tree with one leaf changed: ``copied`` holds the new leaf and its
    ancestors as (level, position, digest), all other nodes are the block's."""

    def __init__(self, block: Block, position: int, leaf: str):
        self.block, self.copied = block, [(0, position, leaf)]
        for level, (left, right) in enumerate(block.siblings(position), 1):
            position //= FAN
            leaf = digest((left, leaf, right))
            self.copied.append((level, position, leaf))

    @property
    def root(self) -> str:
        return self.copied[-1][2]

    def node(self, level: int, position: int) -> str:
        own = self.copied[level]
        return own[2] if own[1] == position else self.block.nodes[level][position]


def climb(leaf: str, path: Iterable) -> Iterator[str]:
    """The copied ancestors along a stored path of (left, right) digests."""
    for left, right in path:
        leaf = digest((left, leaf, right))
        yield leaf


# ---- positions -------------------------------------------------------------------------
def positions(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` (a stored table) with ``pos``, the gapless place of each row
    in its ``tree`` by ``order``, and ``n``, the tree's number of rows."""
    spark = nodes.sparkSession
    key = [tree, *order]
    # the row number splits fully equal rows over partitions; any order of them will do
    dealt = (nodes.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(shuffle_parts(spark), *key, "_tie").sortWithinPartitions(*key, "_tie")
             .drop("_tie"))
    at = F.monotonically_increasing_id()
    placed = stored(dealt.withColumn("_part", F.spark_partition_id())
                    .withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))), "sorted")
    cells = placed.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_rows"),
                                              F.min("_at").alias("_first"))
    by_tree = Window.partitionBy(tree)          # at most one row per partition and tree
    before = F.sum("_rows").over(by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select(tree, "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                         F.sum("_rows").over(by_tree).alias("n"))
    return (placed.join(cells.hint("merge"), [tree, "_part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_part", "_at", "_first", "_before"))


# ---- rounds of blocks ------------------------------------------------------------------
_PATH = "array<struct<left:string,right:string>>"


def block_roots(nodes: DataFrame, levels: int = HEIGHT) -> DataFrame:
    """(tree, pos, n, digest) of the nodes above each aligned block of (tree,
    pos, n, digest). A tree of at most one block ends in its root (n = 1)."""
    size = FAN ** levels

    def build(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("pos", ignore_index=True)
        n = int(df["n"].iloc[0])
        top = Block(df["digest"].tolist(), min(levels, height(n))).root
        return pd.DataFrame({"tree": df["tree"].iloc[:1], "pos": [int(df["pos"].iloc[0]) // size],
                             "n": [-(-n // size)], "digest": [top]})

    return (nodes.select("tree", "pos", "n", "digest", F.expr(f"pos div {size}").alias("block"))
            .groupBy("tree", "block").applyInPandas(build, "tree string, pos long, n long, digest string"))


def node_paths(nodes: DataFrame, above: DataFrame | None, levels: int = HEIGHT) -> DataFrame:
    """(tree, pos, path) of every node up to its tree's root: the path within
    its block and, from ``above`` (paths of the blocks' nodes), beyond it."""
    schema = f"tree string, pos long, path {_PATH}"
    size = FAN ** levels

    def within(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("pos", ignore_index=True)
        block = Block(df["digest"].tolist(), min(levels, height(int(df["n"].iloc[0]))))
        paths = [[{"left": a, "right": b} for a, b in block.siblings(i)] for i in range(len(df))]
        return pd.DataFrame({"tree": df["tree"], "pos": df["pos"], "path": paths})

    own = (nodes.select("tree", "pos", "n", "digest", F.expr(f"pos div {size}").alias("block"))
           .groupBy("tree", "block").applyInPandas(within, schema))
    if above is None:
        return own
    up = above.select("tree", F.col("pos").alias("block"), F.col("path").alias("upper"))
    return (own.withColumn("block", F.expr(f"pos div {size}")).join(up.hint("merge"), ["tree", "block"])
            .select("tree", "pos", F.concat("path", "upper").alias("path")))


def trees(leaves: DataFrame, levels: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """(roots, paths) of all trees over ``leaves`` (tree, pos, n, digest):
    ``roots`` is (tree, digest), ``paths`` is (tree, pos, path) of the nodes
    above the first blocks. Rounds: the height of the tallest tree / ``levels``."""
    rounds = [stored(block_roots(leaves, levels), "nodes")]
    while not rounds[-1].filter("n > 1").isEmpty():
        rounds.append(stored(block_roots(rounds[-1], levels), "nodes"))
    paths = None
    for nodes in reversed(rounds):
        paths = node_paths(nodes, paths, levels)
        if nodes is not rounds[0]:
            paths = stored(paths, "paths")
    return rounds[-1].select("tree", "digest"), paths


# ---- the manifest ----------------------------------------------------------------------
def tampered(text: Column) -> Column:
    """What tampering leaves of a text: it loses its line ends."""
    return F.translate(text, "\n", "")


def row_leaves(docs: DataFrame, chosen: Column, change=tampered) -> DataFrame:
    """(doc_id, source, tree, leaf, changed): ``changed`` is the leaf after
    ``change`` of the text where ``chosen`` holds, else null."""
    *others, text = [F.col(c) for c in FIELDS]
    return docs.select("doc_id", "source", field(F.col("source")).alias("tree"),
                       leaf(*others, text).alias("leaf"),
                       F.when(chosen, leaf(*others, change(text))).alias("changed"))


def source_trees(leaves: DataFrame, levels: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """(placed leaves, blocks): the placed leaves have ``tree``, ``pos``, ``n``;
    ``blocks`` is (tree, block, path, subroot, root) of every block of leaves,
    its path going on to the dataset's root."""
    placed = stored(positions(leaves, "tree", ["doc_id", "leaf"]), "leaves")
    subroots, paths = trees(placed.select("tree", "pos", "n", F.col("leaf").alias("digest")), levels)
    # a tree is named by its source as it enters a leaf
    source = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)"))
    tops = stored(subroots.select(F.lit(TOP_TREE).alias("top"), source.alias("source"), "tree",
                                  F.col("digest").alias("subroot")), "subroots")
    tops = stored(positions(tops, "top", ["source"]), "tops")        # null sorts first
    nodes = tops.select(F.col("top").alias("tree"), "pos", "n", F.col("subroot").alias("digest"))
    root, above = trees(nodes, levels)
    only = root.first()                                              # one digest
    upper = (node_paths(nodes, above, levels).select("pos", F.col("path").alias("upper"))
             .join(tops.select(F.col("tree").alias("t"), "subroot", "pos").hint("merge"), "pos")
             .select(F.col("t").alias("tree"), "upper", "subroot",
                     F.lit(only.digest if only else None).cast("string").alias("root")))
    blocks = (paths.join(stored(upper, "upper").hint("merge"), "tree")
              .select("tree", F.col("pos").alias("block"), F.concat("path", "upper").alias("path"),
                      "subroot", "root"))
    return placed, blocks


MANIFEST = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string")


def manifest(docs: DataFrame, chosen: Column | None = None, change=tampered,
             levels: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row. ``folded_root`` is the root of the version that the row's leaf
    makes after ``change`` (where ``chosen`` holds; by default where 2 divides
    the id's crc32), else the original's."""
    size = FAN ** levels
    if chosen is None:
        chosen = id_fold(F.col("doc_id"), 2) == 0
    leaves = stored(row_leaves(docs, chosen, change), "row_leaves")
    placed, paths = source_trees(leaves, levels)

    def versions(key, rows: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        block = Block(rows["leaf"].tolist(), min(levels, height(int(rows["n"].iloc[0]))))
        upper = [(p["left"], p["right"]) for p in path["path"].iloc[0]]
        original = block.root
        for original in climb(original, upper):
            pass
        tail = "".join(a + b for a, b in upper)
        proofs, folded = [], []
        for at, changed in enumerate(rows["changed"]):
            own = block.siblings(at)
            proofs.append(digest([a + b for a, b in own] + [tail]))
            if changed is None or changed != changed:
                folded.append(original)
                continue
            top = Version(block, at, changed).root
            for top in climb(top, upper):
                pass
            folded.append(top)
        return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "leaf": rows["leaf"],
                             "subroot": path["subroot"].iloc[0], "root": path["root"].iloc[0],
                             "proof_sha256": proofs, "folded_root": folded})

    blocks = placed.select("tree", F.expr(f"pos div {size}").alias("block"), "pos", "n",
                           "doc_id", "leaf", "changed")
    made = (blocks.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block"))
            .applyInPandas(versions, MANIFEST))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def copied_nodes(docs: DataFrame, chosen: Column | None = None, change=tampered,
                 levels: int = HEIGHT) -> DataFrame:
    """``doc_id, source, level, pos, digest``: the nodes each version adds to
    the stored tree, from its changed leaf to the dataset's root; ``level``
    counts from the leaf, ``pos`` is the place in the level of the source's tree
    (null above the source's root)."""
    size = FAN ** levels
    if chosen is None:
        chosen = id_fold(F.col("doc_id"), 2) == 0
    leaves = stored(row_leaves(docs, chosen, change), "row_leaves")
    placed, paths = source_trees(leaves, levels)

    def copies(key, rows: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        n = int(rows["n"].iloc[0])
        block = Block(rows["leaf"].tolist(), min(levels, height(n)))
        upper = [(p["left"], p["right"]) for p in path["path"].iloc[0]]
        out = []
        for at, row in enumerate(rows.itertuples()):
            if row.changed is None or row.changed != row.changed:
                continue
            made = [d for _, _, d in Version(block, at, row.changed).copied]
            made += list(climb(made[-1], upper))
            where = int(row.pos)
            for level, d in enumerate(made):
                out.append((row.doc_id, row.source, level, where if level <= height(n) else None, d))
                where //= FAN
        df = pd.DataFrame(out, columns=["doc_id", "source", "level", "pos", "digest"])
        return df.astype({"doc_id": "Int64", "pos": "Int64"})

    blocks = placed.select("tree", F.expr(f"pos div {size}").alias("block"), "pos", "n",
                           "doc_id", "source", "leaf", "changed")
    return (blocks.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block"))
            .applyInPandas(copies, "doc_id long, source string, level int, pos long, digest string"))
