"""SimHash near-duplicates with BK-trees (operator 7).

Fingerprints: every word shingle of the lower-cased text is hashed (XXH64); a
bit of the fingerprint is set where more than half of the hashes have it.

Links: two fingerprints link at ``radius`` or fewer differing bits. The search
runs over the distinct fingerprints only, in shards: the 64 bits are cut into
``blocks`` blocks, and two fingerprints within ``radius`` bits agree on at least
``blocks - radius`` whole blocks, so every linked pair meets in the shard of
some choice of that many blocks. A shard's members form a BK-tree, whose
children are keyed by their Hamming distance to the parent, and each query
follows only the edges within the radius. More blocks make smaller shards of
more bits; their number follows from the count of fingerprints, the result does
not depend on it. A shard with more than ``CELL`` members (a large family of
near copies) is cut into sub-shards: each pair of sub-shards is a cell with a
tree of one part and the queries of the other, so a task holds at most about
two parts. Trees travel to the tasks by shuffle: their number grows with the
corpus, so no bound for a broadcast could be proven.

A cell reports a spanning forest of the links it finds, never all pairs; the
components of the whole are found by alternating large-star and small-star
steps over the shared folder.

Defined results: null, empty and blank texts have no words and the fingerprint
zero, which links like any other; fewer words than a shingle make one shingle;
a null id is never the smallest of a component unless all its ids are null;
of rows that tie on the smallest id exactly one stays in ``dedup``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stored

SHINGLE = 4
RADIUS = 4
SEED = 42
SHARD_TARGET = 256      # wanted members of a shard on average
MAX_BLOCKS = 8
CELL = 4096             # members of one part of a large shard
FRONTIER = 400_000      # (query, node) pairs looked at together


# ---- fingerprints -------------------------------------------------------------
def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()    # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    counts, total = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 16):
        stop = min(total, at + (1 << 16))
        last = ends[at + shingle - 1:stop + shingle - 1] or [ends[-1]]
        h = np.array([digest(joined[a:b - 1], SEED)
                      for a, b in zip(starts[at:stop], last, strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > total))


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def simhash64(texts: pd.Series) -> pd.Series:
        fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(fps.view(np.int64))
    return simhash64(text)


# ---- BK-trees -------------------------------------------------------------------
class BKForest:
    """One BK-tree per group of ``fps``, all grown and searched level by level
    with array operations. ``group`` numbers the trees, 0 to ``trees - 1``."""

    def __init__(self, fps: np.ndarray, group: np.ndarray, trees: int):
        self.fps, self.root = fps, np.full(trees, -1, np.int64)
        parents, children = [], []
        active = np.argsort(group, kind="stable")
        slot = group[active].astype(np.int64)           # roots: the tree; below: parent * 65 + edge
        level = 0
        while len(active):
            first = np.r_[True, slot[1:] != slot[:-1]]
            node = active[first]
            if level == 0:
                self.root[slot[first]] = node
            else:
                parents.append(slot[first])
                children.append(node)
            above = node[np.cumsum(first) - 1][~first]
            active = active[~first]
            slot = above * 65 + np.bitwise_count(fps[active] ^ fps[above])
            order = np.argsort(slot, kind="stable")
            active, slot, level = active[order], slot[order], level + 1
        self.edge = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.child = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(self.edge)
        self.edge, self.child = self.edge[order], self.child[order]

    def within(self, queries: np.ndarray, tree: np.ndarray,
               radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query numbers, member numbers) at most ``radius`` apart, in pieces."""
        rooted = np.flatnonzero(self.root[tree] >= 0)
        todo = [(rooted, self.root[tree[rooted]])]
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                todo += [(q[FRONTIER:], node[FRONTIER:])]
                q, node = q[:FRONTIER], node[:FRONTIER]
            d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), side="right")
            n = hi - lo
            if n.any():
                at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                todo.append((np.repeat(q, n), self.child[at]))


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of ``a[i]`` and ``b[i]``; ``label`` holds each item's
    smallest member."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def _search(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows (cell, part, tree_part, query_part, fp) come sorted by cell."""
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        cell = pdf["cell"].to_numpy()
        tree = np.cumsum(np.r_[True, cell[1:] != cell[:-1]]) - 1
        fps = pdf["fp"].to_numpy().view(np.uint64)
        part = pdf["part"].to_numpy()
        member = np.flatnonzero(part == pdf["tree_part"].to_numpy())
        query = np.flatnonzero(part == pdf["query_part"].to_numpy())
        forest = BKForest(fps[member], tree[member], int(tree[-1]) + 1)
        label = np.arange(len(fps))
        for q, m in forest.within(fps[query], tree[query], radius):
            join_labels(label, query[q], member[m])
        linked = np.flatnonzero(label != np.arange(len(fps)))
        signed = pdf["fp"].to_numpy()
        return pd.DataFrame({"a": signed[linked], "b": signed[label[linked]]})

    held: list[pd.DataFrame] = []
    for pdf in batches:
        pdf = pd.concat([*held, pdf], ignore_index=True) if held else pdf
        if not len(pdf):
            continue
        cell = pdf["cell"].to_numpy()
        cut = int(np.searchsorted(cell, cell[-1]))      # the last cell may go on
        if cut:
            yield links(pdf.iloc[:cut].reset_index(drop=True))
        held = [pdf.iloc[cut:]]
    if held:
        yield links(held[0].reset_index(drop=True))


# ---- links and components ----------------------------------------------------------
def masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of all choices of ``blocks - radius`` of ``blocks`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(block, blocks - radius)]


def plan_masks(n: int, radius: int) -> list[int]:
    blocks = radius + 1
    while blocks < radius + MAX_BLOCKS - 4 and n >> (64 * (blocks - radius) // blocks) > SHARD_TARGET:
        blocks += 1
    return masks(blocks, radius)


def links(fps: DataFrame, radius: int = RADIUS, n: int | None = None) -> DataFrame:
    """(a, b): a spanning set of the links among distinct fingerprints ``fp``
    (long): two of them are connected by these rows exactly when they are
    connected by links."""
    n = fps.count() if n is None else n
    signed = [m - (1 << 64) if m >> 63 else m for m in plan_masks(n, radius)]
    shard = F.explode(F.array(*[F.struct(F.lit(i).alias("t"),
                                         F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                                for i, m in enumerate(signed)]))
    member = fps.select("fp", shard.alias("s")).select("fp", "s.t", "s.k")
    large = (member.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > CELL))
    parts = F.coalesce(F.ceil(F.col("n") / CELL), F.lit(1)).cast("int")
    cells = (member.join(large, ["t", "k"], "left").withColumn("parts", parts)
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("tree_part", F.least("part", "other"))
             .withColumn("query_part", F.greatest("part", "other"))
             .select(F.xxhash64("t", "k", "tree_part", "query_part").alias("cell"),
                     "part", "tree_part", "query_part", "fp"))
    # equal cell hashes of two shards only put them into one tree: more
    # candidates, the same links
    return (cells.repartition("cell").sortWithinPartitions("cell")
            .mapInPandas(lambda it: _search(it, radius), "a long, b long"))


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root the smallest node
    connected to it."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        # every node's smallest neighbour (itself included), then the links move there
        if large:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        e = e.join(low, "a")
        if large:
            out = e.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"),
                                                           F.col("m").alias("b"))
        else:
            out = e.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select("a", F.col("m").alias("b")))
        return out.filter("a > b").distinct()

    mark = None
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a > b").distinct(), "edges")
    for _ in range(max_rounds):
        e = stored(star(e, large=True), "large")
        e = stored(star(e, large=False), "small")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                    F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).collect()[0]
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def component_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints``
    (doc_id, fp): the component's root fingerprint and the smallest doc_id
    reachable over links (null if all ids are)."""
    uniq = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    edges = links(uniq.select("fp"), radius)
    comp = stored(connected(edges), "components")
    tagged = uniq.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    low = (tagged.filter(F.col("root").isNotNull()).groupBy("root")
           .agg(F.min("rep").alias("low")))
    return (tagged.join(low, "root", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"),
                    F.coalesce("low", "rep").alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = stored(docs.select(F.col(id_col).alias("doc_id"),
                                fingerprint_column(F.col(text_col), shingle).alias("fp")), "prints")
    return (prints.join(component_of(prints, radius), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest id."""
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    base = stored(docs.select(F.struct(*cols).alias("doc"), F.col(id_col).alias("doc_id"),
                              F.monotonically_increasing_id().alias("row")), "rows")
    text = f"doc.c{docs.columns.index(text_col)}"
    prints = stored(base.select("doc_id", "row", fingerprint_column(F.col(text), shingle)
                                .alias("fp")), "prints")
    keep = (prints.join(component_of(prints.select("doc_id", "fp"), radius), "fp")
            .groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("k"))
            .select("k.row"))
    return (base.join(keep, "row", "left_semi")
            .select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)]))

