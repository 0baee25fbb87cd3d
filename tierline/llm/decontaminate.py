"""Benchmark decontamination by a BM25 index with block-max pruning (operator 5).

Index: the test items are the documents of a BM25 inverted index; an item's
impacts are divided by the score it gives itself, so a text holding all of
its words scores 1 against it, long item or short. Items are sorted by length
and cut into shards of at most ``SHARD_ITEMS`` items and ``SHARD_POSTINGS``
postings, the proven bound of what is broadcast; each shard is one pass over
the texts. A shard's items form blocks of ``BLOCK``, and for every term the
index holds its largest impact in the shard and in each block.

Search: every training text is one query of its different words: it is dropped
if the sum of its terms' largest impacts stays below the threshold, then block
by block with the blocks' bounds, and only items of the surviving blocks are
scored (the pruning rule of block-max WAND, run over arrays of texts instead of
one list cursor at a time). An item's threshold is ``RETRIEVE`` or, if lower,
the least score that a text passing the verification can have (``least_score``),
so nothing the verification would accept is lost, wherever in the text the
pieces stand and whichever items share the shard.

Verification: a retrieved text is a leak if the whole of it holds at least
``OVERLAP`` of the five-word shingles of the item's question and of its answer. Items come
with question and answer columns, or as one text whose first two thirds count
as the question and the rest as the answer, five words at least each.

Defined results: null and empty texts leak nothing; items without words are
never found; a part shorter than a shingle is one shingle of its length; an empty item table
finds nothing; repeated rows give the same hits and are reported once per
(doc_id, item_id).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import stored

K1, B = 1.2, 0.75
RETRIEVE = 0.5          # share of an item's own score a text must reach
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 16
SHARD_ITEMS = 1024
SHARD_POSTINGS = 500_000
WORDS_AT_ONCE = 1_000_000
WORDS = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def shingles(w: list[str], k: int = SHINGLE) -> set[str]:
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


# ---- index ------------------------------------------------------------------------
def _postings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for item, q, a in zip(pdf["item_id"], pdf["question"], pdf["answer"], strict=True):
            wq, wa = words(q), words(a)
            tf = Counter(wq + wa)
            n = len(wq) + len(wa)
            if a is None:                               # neither part below a shingle
                cut = -(-2 * n // 3)
                wq, wa = wq[:max(cut, SHINGLE)], wq[min(cut, max(0, n - SHINGLE)):]
            if n:
                rows.append((item, n, wq, wa, list(tf), list(tf.values())))
        yield pd.DataFrame(rows, columns=["item_id", "len", "q", "a", "terms", "tf"])


def item_shards(items: DataFrame, text_col: str = "text", question_col: str | None = None,
                answer_col: str | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(items with their shard number, document frequency per term, shards)."""
    parts = items.select("item_id", F.col(question_col or text_col).alias("question"),
                         (F.col(answer_col) if answer_col else F.lit(None).cast("string"))
                         .alias("answer"))
    rows = stored(parts.mapInPandas(
        _postings, "item_id long, len int, q array<string>, a array<string>, terms array<string>, "
                   "tf array<int>"), "items")
    df = stored(rows.select(F.explode("terms").alias("term")).groupBy("term")
                .agg(F.count(F.lit(1)).alias("df")), "terms")
    n, postings = rows.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).collect()[0]
    shards = max(-(-n // SHARD_ITEMS), -(-(postings or 0) // SHARD_POSTINGS))
    # like lengths share a shard: cut at quantiles of the length, ties by hash
    if shards > 1:
        cuts = rows.select("len").approxQuantile("len", [i / shards for i in range(1, shards)], 0.001)
        no = sum((F.col("len") > c).cast("int") for c in sorted(set(cuts)))
        sized = rows.withColumn("band", no)
        per = sized.groupBy("band").agg(F.count(F.lit(1)).alias("items"),
                                        F.sum(F.size("terms")).alias("postings"))
        split = F.greatest(F.ceil(F.col("items") / (SHARD_ITEMS * 0.8)),
                           F.ceil(F.col("postings") / (SHARD_POSTINGS * 0.8)))
        rows = (sized.join(per.select("band", split.alias("split")), "band")
                .withColumn("sub", F.pmod(F.xxhash64("item_id"), "split")))
    else:
        rows = rows.withColumn("band", F.lit(0)).withColumn("sub", F.lit(0))
    return rows, df, n


def least_score(parts: list[list[str]], weight: dict[str, float]) -> float:
    """A score that no text holding ``OVERLAP`` of each part's shingles is below.
    A term is missing only if all shingles with it are, and a missing shingle
    counts for ``SHINGLE`` terms at most: the dearest such terms, the last one
    in part (a fractional knapsack, never below what a text can lose)."""
    room, holds, may = 0, Counter(), set(weight)
    for w in parts:
        found = shingles(w, min(SHINGLE, len(w)))
        spare = len(found) - math.ceil(OVERLAP * len(found))
        here = Counter(t for s in found for t in set(s.split(" ")))
        may -= {t for t, c in here.items() if c > spare}
        holds += here
        room += SHINGLE * spare
    lost = 0.0
    for t in sorted(may, key=lambda t: weight[t] / holds[t], reverse=True):
        lost += weight[t] * min(1.0, room / holds[t])
        room -= holds[t]
        if room <= 0:
            break
    return sum(weight.values()) - lost


class ShardIndex:
    """Block-max BM25 index of one shard, as arrays."""

    def __init__(self, items: list, df: dict[str, int], n: int, mean_len: float):
        items = sorted(items, key=lambda r: (r.len, r.item_id is None, r.item_id or 0))
        self.ids = [r.item_id for r in items]
        self.parts = [[(min(SHINGLE, len(w)), shingles(w)) for w in (r.q, r.a)] for r in items]
        self.vocab: dict[str, int] = {}
        blocks = -(-len(items) // BLOCK)
        entries, least = [], []
        for i, r in enumerate(items):
            t = np.array([self.vocab.setdefault(x, len(self.vocab)) for x in r.terms])
            tf = np.array(r.tf, float)
            f = np.array([df[x] for x in r.terms], float)
            w = np.log1p((n - f + 0.5) / (f + 0.5)) * tf * (K1 + 1) / (
                tf + K1 * (1 - B + B * r.len / mean_len))
            w /= w.sum()
            entries.append((i, t, w))
            least.append(min(RETRIEVE, least_score([r.q, r.a], dict(zip(r.terms, w.tolist(), strict=True)))))
        self.least = np.array(least) - 1e-4             # below any rounding of the sums
        self.block_max = np.zeros((len(self.vocab), blocks), np.float32)
        self.blocks = []
        for b in range(blocks):
            mine = entries[b * BLOCK:(b + 1) * BLOCK]
            terms = np.unique(np.concatenate([t for _, t, _ in mine]))
            impact = np.zeros((len(terms), len(mine)), np.float32)
            for j, (_, t, w) in enumerate(mine):
                impact[np.searchsorted(terms, t), j] = w
            self.block_max[terms, b] = impact.max(axis=1)
            self.blocks.append((terms, impact))
        self.term_max = self.block_max.max(axis=1)

    def search(self, texts: list[list[str]]):
        """(text number, item number, score) of every text and item with a
        score of at least the item's threshold, text by text."""
        get, v = self.vocab.get, len(self.vocab)
        key = [np.zeros(0, np.int64)]
        for i, w in enumerate(texts):
            t = np.unique(np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)))
            key.append(t[t >= 0] + i * v)
        c, t = np.divmod(np.concatenate(key), v)
        total = np.bincount(c, weights=self.term_max[t], minlength=len(texts))
        maybe = np.flatnonzero(total >= self.least.min())
        lo, hi = np.searchsorted(c, maybe), np.searchsorted(c, maybe + 1)
        block_least = np.minimum.reduceat(self.least, np.arange(0, len(self.least), BLOCK))
        for i, x, y in zip(maybe.tolist(), lo.tolist(), hi.tolist(), strict=True):
            q = t[x:y]
            bound = self.block_max[q].sum(axis=0)
            for b in np.flatnonzero(bound >= block_least).tolist():
                terms, impact = self.blocks[b]
                at = np.searchsorted(terms, q)
                at[at == len(terms)] = 0
                score = impact[at[terms[at] == q]].sum(axis=0)
                for j in np.flatnonzero(score >= self.least[b * BLOCK:(b + 1) * BLOCK]).tolist():
                    yield i, b * BLOCK + j, float(score[j])

    def leaks(self, texts: list[str | None]):
        """(text number, item number, score, found and all shingles of the
        question, of the answer) of the verified leaks."""
        batch: list[list[str]] = []
        at, size = 0, 0
        for i, text in enumerate([*texts, None]):
            last = i == len(texts)
            if last or size > WORDS_AT_ONCE:
                yield from ((at + k, *r) for k, r in self._verified(batch))
                at, batch, size = i, [], 0
            if not last:
                batch.append(words(text))
                size += len(batch[-1])

    def _verified(self, texts: list[list[str]]):
        of, held = -1, {}
        for i, item, score in self.search(texts):
            if i != of:
                of, held = i, {}
            found = []
            for k, s in self.parts[item]:
                if k not in held:
                    held[k] = shingles(texts[i], k)
                found += [len(s & held[k]), len(s)]
            if found[0] >= OVERLAP * found[1] and found[2] >= OVERLAP * found[3]:
                yield i, (item, score, *found)


def build_shards(items: DataFrame, **cols) -> Iterator[ShardIndex]:
    """The shards' indexes, one at a time on the driver, each within the bound."""
    rows, df, n = item_shards(items, **cols)
    if not n:
        return
    mean_len = rows.agg(F.avg("len")).collect()[0][0]
    for key in sorted(rows.select("band", "sub").distinct().collect()):
        shard = rows.filter((F.col("band") == key.band) & (F.col("sub") == key["sub"]))
        terms = (shard.select(F.explode("terms").alias("term")).distinct()
                 .join(df, "term").collect())
        yield ShardIndex(shard.select("item_id", "len", "q", "a", "terms", "tf").collect(),
                         {r.term: r.df for r in terms}, n, mean_len)


# ---- Spark --------------------------------------------------------------------------
def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **cols) -> DataFrame:
    """One row per leaked (doc_id, item_id): the BM25 score of the text
    and the shingles of question and answer found in it."""
    spark = docs.sparkSession
    schema = ("doc_id long, item_id long, score double, question_found int, question_shingles int, "
              "answer_found int, answer_shingles int")
    out = spark.createDataFrame([], schema)
    for index in build_shards(items, **cols):
        sent = spark.sparkContext.broadcast(index)

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                idx, ids = sent.value, pdf["doc_id"].tolist()
                rows = [(ids[i], idx.ids[item], *rest)
                        for i, item, *rest in idx.leaks(pdf["text"].tolist())]
                got = pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])
                yield got.astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(docs.select(F.col(id_col).alias("doc_id"),
                                          F.col(text_col).alias("text")).mapInPandas(scan, schema))
    best = F.max(F.struct("score", "question_found", "question_shingles", "answer_found",
                          "answer_shingles")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def leak_column(spark: SparkSession, index: ShardIndex, text: Column) -> Column:
    sent = spark.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def has_leak(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        for i, *_ in sent.value.leaks(texts.tolist()):
            out[i] = True
        return pd.Series(out)
    return has_leak(text)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **cols) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    for index in build_shards(items, **cols):
        docs = docs.filter(~leak_column(docs.sparkSession, index, F.col(text_col)))
    return docs
