"""Language-model scores by partial matching over bytes (operator 8).

The text is normalised (A-Z lowered, words joined by one space) and ended by a
line feed. The model is prediction by partial matching: a trie of byte contexts
of up to ``ORDER`` bytes with the counts of the bytes that followed them in the
training texts. A byte's probability is looked up in the longest context known;
where it never followed, the model escapes to the next shorter context,
excluding the symbols already refused (symbol exclusion), down to the uniform
distribution over what is left. Escapes are estimated as in method D: with total
T and D different symbols, a symbol of count c has ``(2c - 1) / 2T`` and the
escape ``D / 2T``. A text's score is the sum of log10 probabilities of its
bytes, its code length under the pretrained trie. Before a text's first byte the
context is line feeds.

Beside it stands a word model: add-half smoothed unigrams with one end token
per document.

Scale: texts are gathered into blocks of about ``BLOCK_BYTES`` (stored in the
shared folder, one row each, compressed). A block asks for its distinct n-grams
and words, with their counts from training documents, so what leaves a block is
the size of its vocabulary, not of its text. The trie is never in one place: it is
dealt into shards by two-byte suffix, within which all longer contexts of an
n-gram lie. A suffix that blocks ask for more than ``CROWD`` times is parted by one
more byte, and so on, so that no shard grows with the corpus; what all of a parted
context's shards need is broadcast: its counts by symbol, and the two shortest
levels (at most 256 + 256 * 256 counts). An ask is one row per block and shard,
keys and counts packed; a shard sums the counts of all blocks and answers each.
Words are known by a 64-bit hash.

Defined results: null and empty texts are the end alone; rows that repeat are
scored (and learned) each; without training documents every byte has
probability 1/256 and every token 1/(V+1) with V = 0; a null id is in the fold
of the empty text. Very long texts make a block of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import id_fold, shuffle_parts, stored

ORDER = 5
BLOCK_BYTES = 16 << 20
PIECE = 1 << 20         # positions looked at together
END = 10
SHARDS_PER_PARTITION = 4
CROWD = 1 << 20         # asks of one context, over all blocks, from which on it is parted
ANSWERS = 256           # rows of answers made together
NGRAM, WORD, CROWDED = 0, 1, 2

BLOCKS = "block long, ids array<string>, held array<boolean>, lens array<long>, text binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---- a block's text as symbols ----------------------------------------------------------
def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


class Stream:
    """The texts of a block, each ended by a line feed."""

    LINE_FEEDS = np.uint64(int.from_bytes(bytes([END] * (ORDER + 1))))

    def __init__(self, text: bytes, lens: np.ndarray):
        self.a = np.frombuffer(text, np.uint8)
        self.lens = np.asarray(lens, np.int64) + 1      # with the end
        self.ends = np.cumsum(self.lens)
        self.begins = self.ends - self.lens

    def ngrams(self, at: int, stop: int) -> np.ndarray:
        """The symbol at each position from ``at`` to ``stop`` with the ORDER
        symbols before it, as one number; what lies before a text's first byte
        is a line feed."""
        pad = max(0, ORDER - at)
        a = np.r_[np.full(pad, END, np.uint8), self.a[at + pad - ORDER:stop]].astype(np.uint64)
        key = np.zeros(stop - at, np.uint64)
        for back in range(ORDER, -1, -1):
            key = (key << np.uint64(8)) | a[ORDER - back:len(a) - back]
        near = slice(*np.searchsorted(self.begins, [at - ORDER, stop]))
        for place in range(ORDER):                      # behind these bytes stands another text
            head = self.begins[near] + place
            head = head[(head >= at) & (head < np.minimum(self.ends[near], stop))] - at
            own = np.uint64((1 << (8 * (place + 1))) - 1)
            key[head] = (key[head] & own) | (self.LINE_FEEDS & ~own)
        return key

    def docs(self, at: int, stop: int) -> np.ndarray:
        """The document number of each position from ``at`` to ``stop``."""
        first, last = np.searchsorted(self.ends, [at, stop - 1], side="right")
        ends = np.minimum(self.ends[first:last + 1], stop)
        return np.repeat(np.arange(first, last + 1), np.diff(ends, prepend=at))

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hash, document number) of the tokens, piece by piece; the end
        token's hash is 0."""
        at = 0
        while at < len(self.a):
            stop = at + PIECE
            while stop < len(self.a):                   # a piece ends behind a word
                gap = np.flatnonzero(self._gap(self.a[stop - 1:stop + PIECE]))
                if len(gap):
                    stop += int(gap[0])
                    break
                stop += PIECE
            yield self._words(at, min(stop, len(self.a)))
            at = stop

    @staticmethod
    def _gap(a: np.ndarray) -> np.ndarray:
        return (a == 32) | (a == END)

    def _words(self, at: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        a = self.a[at:stop]
        ends = np.searchsorted(self.ends, np.flatnonzero(a == END) + at, side="right")
        inside = np.flatnonzero(~self._gap(a))
        if not len(inside):
            return np.zeros(len(ends), np.uint64), ends
        head = np.flatnonzero(np.r_[True, np.diff(inside) > 1])
        length = np.diff(np.r_[head, len(inside)])
        place = np.arange(len(inside)) - np.repeat(head, length)
        powers = np.cumprod(np.full(int(length.max()), _ODD, np.uint64), dtype=np.uint64)
        value = (a[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
        h = np.add.reduceat(value, head)
        h = (h ^ (h >> np.uint64(32))) * _ODD
        h = np.maximum(h ^ (h >> np.uint64(29)), np.uint64(1))
        doc = np.searchsorted(self.ends, inside[head] + at, side="right")
        return np.r_[h, np.zeros(len(ends), np.uint64)], np.r_[doc, ends]


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")             # merges what is sorted already
    first = _firsts(keys := keys[order])
    counts = np.concatenate(counts)[order].astype(np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.r_[np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]])


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many of each are of training texts."""
    everywhere, taught = np.sort(keys), np.sort(keys[train])
    keys, first = everywhere[_firsts(everywhere)], _firsts(taught)
    counts = np.zeros(len(keys), np.int64)
    counts[np.searchsorted(keys, taught[first])] = np.diff(first, append=len(taught))
    return keys, counts


def vocabulary(s: Stream, held: np.ndarray):
    """(kind, key, count in training texts) of a block's distinct n-grams and words."""
    train = ~np.asarray(held, bool)
    keys, counts = [], []
    for at in range(0, len(s.a), PIECE):
        stop = min(len(s.a), at + PIECE)
        u, n = counted(s.ngrams(at, stop), train[s.docs(at, stop)])
        keys.append(u)
        counts.append(n)
        if len(keys) > 8:
            keys, counts = ([x] for x in merge(keys, counts))
    yield NGRAM, *merge(keys, counts)
    keys, counts = [], []
    for h, doc in s.words():
        u, n = counted(h, train[doc])
        keys.append(u)
        counts.append(n)
        if len(keys) > 8:
            keys, counts = ([x] for x in merge(keys, counts))
    yield WORD, *merge(keys, counts)


# ---- the trie ---------------------------------------------------------------------------
class Level:
    """Counts of (context, symbol) for contexts of one length, sorted by key;
    keys hold the context's bytes and then the symbol's."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.ctx, first = np.unique(keys >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(counts, first) if len(keys) else np.zeros(0, np.int64)
        self.kinds = np.diff(np.r_[first, len(keys)])

    def shorter(self, order: int) -> Level:
        """The level below one of ``order`` bytes of context."""
        mask = np.uint64((1 << (8 * order)) - 1)
        return Level(*merge([self.keys & mask], [self.counts]))

    @staticmethod
    def _find(where: np.ndarray, x: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        if not len(where):
            return [np.zeros(len(x), np.int64) for _ in values]
        at = np.minimum(np.searchsorted(where, x), len(where) - 1)
        hit = where[at] == x
        return [np.where(hit, v[at], 0) for v in values]

    def count(self, keys: np.ndarray) -> np.ndarray:
        return self._find(self.keys, keys, self.counts)[0]

    def context(self, ctx: np.ndarray) -> list[np.ndarray]:
        """Total and number of symbols of each context."""
        return self._find(self.ctx, ctx, self.total, self.kinds)


def suffix(x: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes of contexts or n-grams."""
    return x & np.uint64((1 << (8 * order)) - 1)


def among(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each of ``x`` is one of ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def crowded(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of 2 to ORDER - 1 bytes with more than ``least`` of a block's
    n-grams, their length before their bytes, and how many they have."""
    found, n = [], []
    ctx = keys >> np.uint64(8)
    for order in range(2, ORDER):
        ordered = np.sort(suffix(ctx, order))
        first = _firsts(ordered)
        have = np.diff(first, append=len(ordered))
        many = ordered[first][have > least]
        found.append(many | np.uint64(order << (8 * ORDER)))
        n.append(have[have > least])
        ctx = ctx[among(many, suffix(ctx, order))]
    return np.concatenate(found), np.concatenate(n)


def log_probabilities(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each n-gram's symbol in its context; ``levels``
    holds the counts for contexts of ORDER, ..., 1, 0 bytes."""
    out = np.zeros(len(keys))
    open_ = np.arange(len(keys))
    # what the longer context saw, taken out of this one: total and kinds
    refused_total, refused_kinds = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for i, level in enumerate(levels):
        order = len(levels) - 1 - i
        k = keys[open_] & np.uint64((1 << (8 * (order + 1))) - 1)
        total, kinds = level.context(k >> np.uint64(8))
        t, d, c = total - refused_total, kinds - refused_kinds, level.count(k)
        hit, esc = (c > 0), (c == 0) & (d > 0)
        out[open_[hit]] += np.log10((2 * c[hit] - 1) / (2.0 * t[hit]))
        out[open_[esc]] += np.log10(d[esc] / (2.0 * t[esc]))
        rest = ~hit
        open_, k, kinds = open_[rest], k[rest], kinds[rest]
        refused_kinds = kinds
        if order:
            # of the next context's counts, those of symbols seen here
            below = levels[i + 1].count(level.keys & np.uint64((1 << (8 * order)) - 1))
            per = np.zeros(len(level.ctx), np.int64)
            np.add.at(per, np.searchsorted(level.ctx, level.keys >> np.uint64(8)), below)
            refused_total = level._find(level.ctx, k >> np.uint64(8), per)[0]
    left = 256 - refused_kinds
    out[open_] -= np.log10(np.maximum(left, 1))
    return out


# ---- Spark --------------------------------------------------------------------------------
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    kinds = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.string())), ("held", pa.list_(pa.bool_())),
                       ("lens", pa.list_(pa.int64())), ("text", pa.binary())])
    ids, held, texts, size = [], [], [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"block": [number], "ids": [ids], "held": [held], "lens": [[len(t) - 1 for t in texts]],
             "text": [zstandard.compress(b"".join(texts), 3)]}, schema=kinds)
    for batch in batches:
        doc, fold, text = (batch.column(c) for c in ("id", "held", "text"))
        for i in range(batch.num_rows):                 # one text at a time in Python
            ids.append(doc[i].as_py())
            held.append(bool(fold[i].as_py()))
            texts.append(normalised(text[i].as_py()) + b"\n")
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield row()
                number += 1
                ids, held, texts, size = [], [], [], 0
    if ids:
        yield row()


def pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, byte planes apart."""
    return pack(np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=np.uint64)


def shard_of(kind: int, keys: np.ndarray, shards: int, parted: Sequence[np.ndarray] = ()) -> np.ndarray:
    """N-grams go by the last two bytes of their context, and by one more where those
    are among ``parted`` (sorted contexts of two bytes, of three, ...)."""
    x = keys
    if kind == NGRAM:
        ctx = keys >> np.uint64(8)
        x = suffix(ctx, 2)
        deep = np.arange(len(keys))
        for order, contexts in enumerate(parted, 2):
            deep = deep[among(contexts, suffix(ctx[deep], order))]
            x[deep] = suffix(ctx[deep], order + 1)
    return (((x * _ODD) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _ask(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            s = Stream(zstandard.decompress(r.text), np.array(r.lens, np.int64))
            for kind, keys, counts in vocabulary(s, np.array(r.held, bool)):
                rows = [(kind, keys, counts)]
                if kind == NGRAM:
                    rows.append((CROWDED, *crowded(keys, least)))
                yield pd.DataFrame([(np.int8(of), r.block, pack_keys(k), pack(c.astype("<u4")))
                                    for of, k, c in rows], columns=["kind", "block", "keys", "counts"])


def _deal(batches: Iterator[pd.DataFrame], shards: int, parted: Sequence[np.ndarray]) -> Iterator[pd.DataFrame]:
    """A block's asks by shard. Of words each shard is asked, since its totals are
    part of its answer."""
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            keys, counts = unpack_keys(r.keys), unpack(r.counts, "<u4")
            shard = shard_of(r.kind, keys, shards, parted)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = [(np.int32(i), np.int8(r.kind), r.block, pack_keys(keys[o]), pack(counts[o]))
                    for i in range(shards) if len(o := order[cuts[i]:cuts[i + 1]]) or r.kind == WORD]
            yield pd.DataFrame(rows, columns=["shard", "kind", "block", "keys", "counts"])


def _by_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one (shard, kind) at a time; they come sorted."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        for _, part in pdf.groupby(["shard", "kind"], sort=False):
            here = (part["shard"].iloc[0], part["kind"].iloc[0])
            if held and here != (held[0]["shard"].iloc[0], held[0]["kind"].iloc[0]):
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def _summed(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ks, cs, size = [], [], 0
    for k, c in zip(rows["keys"], rows["counts"], strict=True):
        ks.append(unpack_keys(k))
        cs.append(unpack(c, "<u4").astype(np.int64))
        size += len(ks[-1])
        if size > max(1 << 19, len(keys)):
            keys, counts = merge([keys, *ks], [counts, *cs])
            ks, cs, size = [], [], 0
    return merge([keys, *ks], [counts, *cs])


def _score(block: pd.DataFrame, answers: pd.DataFrame, n: int, v: int) -> pd.DataFrame:
    r = block.iloc[0]
    s = Stream(r.text, np.array(r.lens, np.int64))
    kind = answers["kind"].to_numpy()

    def table(k: int) -> tuple[pd.Index, np.ndarray]:
        mine = answers[kind == k]
        keys = np.concatenate([unpack_keys(x) for x in mine["keys"]])
        return pd.Index(keys), np.concatenate([unpack(x, "<f8") for x in mine["values"]])

    keys, logp = table(NGRAM)
    score = np.zeros(len(s.ends))
    for at in range(0, len(s.a), PIECE):
        stop = min(len(s.a), at + PIECE)
        value = logp[keys.get_indexer(s.ngrams(at, stop))]
        score += np.bincount(s.docs(at, stop), weights=value, minlength=len(score))
    words, counts = table(WORD)
    of_word = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
    base, tokens, known = (np.zeros(len(score)) for _ in range(3))
    for h, doc in s.words():
        at = words.get_indexer(h)
        for total, of_token in ((base, of_word[at]), (tokens, np.ones(len(at))), (known, counts[at] > 0)):
            total += np.bincount(doc, weights=of_token, minlength=len(score))
    return pd.DataFrame({
        "doc_id": list(r.ids), "held_out": list(r.held), "n_tokens": tokens.astype(np.int64),
        "n_known": known.astype(np.int64), "train_tokens": n, "base_score": base, "score": score})


def score_texts(docs: DataFrame, folds: int = 5, held_fold: int = 1, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every row; the model learns from the rows outside fold ``held_fold``."""
    spark = docs.sparkSession
    blocks = stored(docs.select(F.col(id_col).cast("string").alias("id"),
                                (id_fold(F.col(id_col), folds) == held_fold).alias("held"),
                                F.col(text_col).alias("text")).mapInArrow(_blocks, BLOCKS), "blocks")
    shards = SHARDS_PER_PARTITION * shuffle_parts(spark)
    # where blocks name what they have more of than this, none is missed
    least = CROWD // 2 // max(1, blocks.count())
    asks = stored(blocks.mapInPandas(lambda it: _ask(it, least),
                                     "kind byte, block long, keys binary, counts binary"), "asks")

    def crowds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k, c in zip(pdf["keys"], pdf["counts"], strict=True):
                yield pd.DataFrame({"k": unpack_keys(k).view(np.int64), "n": unpack(c, "<u4").astype(np.int64)})

    crowd = (asks.filter(F.col("kind") == CROWDED).select("keys", "counts").mapInPandas(crowds, "k long, n long")
             .groupBy("k").agg(F.sum("n").alias("n")).filter(F.col("n") > CROWD // 2).select("k").toPandas())
    crowd = np.sort(crowd["k"].to_numpy(np.int64).view(np.uint64))
    parted = [suffix(crowd[crowd >> np.uint64(8 * ORDER) == order], ORDER) for order in range(2, ORDER)]

    def short_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(1 << 16, np.int64)
        of_parted = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in parted]
        for pdf in batches:
            for k, c in zip(pdf["keys"], pdf["counts"], strict=True):
                k, c = unpack_keys(k), unpack(c, "<u4").astype(np.int64)
                k, c = k[c > 0], c[c > 0]
                sums += np.bincount(suffix(k, 2).astype(np.int64), weights=c, minlength=1 << 16).astype(np.int64)
                for i, contexts in enumerate(parted):
                    here = among(contexts, suffix(k >> np.uint64(8), i + 2))
                    k, c = k[here], c[here]
                    old_k, old_c = of_parted[i]
                    of_parted[i] = merge([old_k, suffix(k, i + 3)], [old_c, c])
        some = np.flatnonzero(sums)
        for order, (k, n) in enumerate([(some.astype(np.uint64), sums[some]), *of_parted], 1):
            yield pd.DataFrame({"o": order, "k": k.view(np.int64), "n": n})

    # contexts of one byte and none, at most 256 * 256 rows, and those that lie in several shards
    short = (asks.filter(F.col("kind") == NGRAM).select("keys", "counts")
             .mapInPandas(short_counts, "o int, k long, n long").groupBy("o", "k").agg(F.sum("n").alias("n"))
             .toPandas().sort_values(["o", "k"]))
    short = [(rows["k"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64))
             for rows in (short[short["o"] == order] for order in range(1, ORDER))]
    one = Level(*short[0])
    sent = spark.sparkContext.broadcast(([one, one.shorter(1)], short[1:]))

    def trie(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
        """The levels of a shard; of a context in several shards, with what they all have."""
        short, several = sent.value
        levels = [Level(keys[counts > 0], counts[counts > 0])]
        for order in range(ORDER, 2, -1):
            levels.append(levels[-1].shorter(order))
        for i, (contexts, (all_keys, all_counts)) in enumerate(zip(parted, several, strict=True)):
            asked = np.sort(suffix(keys >> np.uint64(8), i + 2))
            contexts = contexts[among(asked, contexts)]
            if len(contexts):
                level = levels[ORDER - 2 - i]
                own = ~among(contexts, level.keys >> np.uint64(8))
                here = among(contexts, all_keys >> np.uint64(8))
                levels[ORDER - 2 - i] = Level(*merge([level.keys[own], all_keys[here]],
                                                     [level.counts[own], all_counts[here]]))
        return levels + short

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_shard(batches):
            keys, counts = _summed(rows)
            values, kind = counts.astype(float), rows["kind"].iloc[0]
            if kind == NGRAM:
                values = log_probabilities(keys, trie(keys, counts))
            for at in range(0, len(rows), ANSWERS):
                some = rows.iloc[at:at + ANSWERS]
                asked = [pack(values[np.searchsorted(keys, unpack_keys(k))].astype("<f8")) for k in some["keys"]]
                yield pd.DataFrame({"block": some["block"], "kind": kind, "keys": some["keys"], "values": asked,
                                    "n": counts.sum(), "v": (counts > 0).sum()})

    # asks for crowds are answered already
    dealt = (asks.filter(F.col("kind") != CROWDED)
             .mapInPandas(lambda it: _deal(it, shards, parted),
                          "shard int, kind byte, block long, keys binary, counts binary")
             .repartition("shard").sortWithinPartitions("shard", "kind"))
    answers = dealt.mapInPandas(answer, "block long, kind byte, keys binary, values binary, n long, v long")

    def scored(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words = answers[answers["kind"] == WORD]        # from each shard once
        text = [zstandard.decompress(t) for t in block["text"]]
        return _score(block.assign(text=text), answers, int(words["n"].sum()), int(words["v"].sum()))

    schema = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
