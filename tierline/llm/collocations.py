"""Phrase collocations counted in HAT-tries (operator 11).

Plan.

1. Words are counted per language by an ordinary partial + final aggregate,
   then pairs of words, then windows of three words and more, each level only
   where all parts of the level below are frequent: a phrase seen ``min_count``
   times has no part seen less. The frequent words and pairs are marked in
   bitmaps of hashed bits (``WORD_BITS``, ``PAIR_BITS``: 4 and 8 MB whatever the
   corpus), all that is broadcast. A wrongly marked part costs work, never a
   result.
2. Every task counts its windows in a HAT-trie: a shallow trie over word ids
   whose leaves are hash containers of the remaining ids. A container that
   outgrows ``BURST`` entries bursts into one container per next word. When the
   trie holds ``LIMIT`` windows its largest subtrees are spilled whole as sorted
   runs, one per prefix partition: a hash of the language and the pair, or the
   first three words of a longer window.
3. A prefix partition merges its runs in order; equal windows add up, and the
   count of a phrase is the sum over the windows that begin with it. Every
   phrase is complete in its partition.
4. Cuts, scores and the removal of parts of longer phrases are joins and
   aggregates on the phrase; the best of a language are chosen in two steps, so
   that no task holds all phrases of a language.

A task holds ``LIMIT`` windows, one slice of a text and the runs of one prefix
partition; there are ``PARTS_PER_TASK`` partitions per shuffle task.

Defined results: a null or empty text has no words; a null language is
``und``; repeated rows and ids count as often as they occur, null ids too; ties
in score and count go by the phrase's bytes; an empty table gives no rows; a
text of any length is read in slices. Columns other than text and language are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import lower_ascii, shuffle_parts, stored

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
SCALE = 1000
NO_LANG = "und"
# a word: no blank, tab or mark that ends a piece (Java syntax)
PIECE_WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
WORD_BITS, PAIR_BITS = 25, 26       # 2**25 bits = 4 MB
BURST = 4096                # entries of a container before it becomes a trie node
LIMIT = 600_000             # windows a task's trie holds before it spills
CHUNK = 500_000             # windows counted by sorting before they enter the trie
SLICE = 1 << 20             # bytes of text cut into words at once
PARTS_PER_TASK = 2
RANK_GROUPS = 64
ID_BITS = 21
KNOWN = 700_000             # words a task remembers; with those of a slice below 2**ID_BITS
END = b"\xff"               # ends a piece; no byte of UTF-8 text

_MAP = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _MAP[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _MAP[_c] = END[0]
_MAP[9] = 32
_MAP = bytes(_MAP)


# ---- the trie ------------------------------------------------------------------------
class HatTrie:
    """Counts of windows of word ids. A window is (first word, rest), the rest
    packed into one integer, ``ID_BITS`` bits a word, 0 for no word. Nodes map
    a word id to a node or container; a container (a dict within a node) maps
    the packed remaining ids to a count. Depth: at most three words."""

    __slots__ = ("root", "sizes", "words")

    class Node(dict):
        """word id -> node or container"""

    def __init__(self, words: int):
        self.words, self.root, self.sizes = words, self.Node(), {}

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def add(self, first: int, rests, counts) -> int:
        """Adds windows of one first word; returns how many were new."""
        held, new = self._add(self.root.get(first, {}), self.words - 2, rests, counts)
        self.root[first] = held
        self.sizes[first] = self.sizes.get(first, 0) + new
        return new

    def _add(self, held: dict, later: int, rests, counts) -> tuple[dict, int]:
        """Adds to a node or container whose keys begin with one word and go
        on with ``later`` more; (what takes its place, new windows)."""
        shift = later * ID_BITS
        if type(held) is dict:
            before, get = len(held), held.get
            for r, n in zip(rests, counts):
                held[r] = get(r, 0) + n
            new = len(held) - before
            if len(held) <= BURST or later <= self.words - 4 or later <= 0:
                return held, new
            node, mask = self.Node(), (1 << shift) - 1              # burst
            for r, n in held.items():
                node.setdefault(r >> shift, {})[r & mask] = n
            return node, new
        mask, by_word, new = (1 << shift) - 1, {}, 0
        for r, n in zip(rests, counts):
            part = by_word.setdefault(r >> shift, ([], []))
            part[0].append(r & mask)
            part[1].append(n)
        for word, (rest, n) in by_word.items():
            held[word], more = self._add(held.get(word, {}), later - 1, rest, n)
            new += more
        return held, new

    def containers(self, first: int) -> Iterator[tuple[int, dict]]:
        """(packed ids above it, container) of the containers below a first word."""
        def walk(held, later, head):
            if type(held) is dict:
                yield head << ((later + 1) * ID_BITS), held
            else:
                for word, below in held.items():
                    yield from walk(below, later - 1, head << ID_BITS | word)
        return walk(self.root[first], self.words - 2, 0)

    def take(self, share: float) -> list[int]:
        """The first words of the largest subtrees, about ``share`` of all windows."""
        goal, out = self.size * share, []
        for word in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if goal <= 0:
                break
            out.append(word)
            goal -= self.sizes[word]
        return out

    def drop(self, first: int) -> int:
        del self.root[first]
        return self.sizes.pop(first)


def _seed(lang: bytes) -> int:
    return xxhash.xxh64_intdigest(lang, 42)


def pair_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The filter bit of pairs of word hashes."""
    h = (left ^ (right * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _is_marked(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)


class _Language:
    """One language's word ids and trie within a task."""

    def __init__(self, lang: bytes, words: int):
        self.seed = _seed(lang)
        self.ids, self.names = {END: -1}, []
        self.hashes = np.zeros(1024, np.uint64)         # of the names, and room for more
        self.trie, self.keys = HatTrie(words), []

    def new_id(self, word: bytes, h: int) -> int:
        n = len(self.names)
        if n == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(n, np.uint64)])
        self.hashes[n] = h
        self.names.append(word)
        return n


def _slices(text: bytes, size: int) -> Iterator[tuple[bytes, bool]]:
    """Cuts a mapped text after blanks or piece ends; (slice, whether a piece
    goes on behind it)."""
    at = 0
    while len(text) - at > size:
        ends = [p for p in (text.find(b" ", at + size), text.find(END, at + size)) if p >= 0]
        if not ends:
            break
        yield text[at:min(ends)], text[min(ends)] == 32
        at = min(ends)
    yield text[at:], False


def window_keys(ids: np.ndarray, words: int, starts: int, follows: np.ndarray | None = None) -> np.ndarray:
    """Packed windows, (first, rest) as two columns, that start at one of the
    first ``starts`` positions: pairs, or three words and more where ``words``
    allows them. -1 ends a window, and so does a pair that ``follows`` denies
    (by the position of its first word)."""
    n = len(ids)
    padded = np.concatenate([ids, np.full(words, -1, np.int64)])
    if follows is not None:
        follows = np.concatenate([follows, np.zeros(words, bool)])
    cols, alive = [], np.ones(n, bool)
    for k in range(words):
        col = padded[k:k + n]
        alive = alive & (col >= 0)
        if k and follows is not None:
            alive = alive & follows[k - 1:k - 1 + n]
        cols.append(np.where(alive, col + 1, 0))
    use = (cols[min(words, 3) - 1] > 0) & (np.arange(n) < starts)
    hi = (cols[0][use] << ID_BITS) | cols[1][use]
    lo = np.zeros(len(hi), np.int64)
    for col in cols[2:]:
        lo = (lo << ID_BITS) | col[use]
    return np.stack([hi, lo], axis=1)


class WindowCounter:
    """Counts the windows of a task's texts; hands out sorted runs. ``marked``
    is the bitmap of words, ``pairs`` that of pairs (None: every pair counts)."""

    def __init__(self, marked: bytes, words: int, parts: int, pairs: bytes | None = None,
                 limit: int = LIMIT, chunk: int = CHUNK, piece: int = SLICE, known: int = KNOWN):
        self.marked, self.words, self.parts = marked, words, parts
        self.pairs = None if pairs is None else np.frombuffer(pairs, np.uint8)
        self.limit, self.chunk, self.piece, self.known = limit, chunk, piece, known
        self.langs: dict[str, _Language] = {}
        self.size = self.buffered = 0

    def _id(self, lang: _Language, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, lang.seed)
        bit = h & ((1 << WORD_BITS) - 1)
        return lang.new_id(word, h) if self.marked[bit >> 3] >> (bit & 7) & 1 else -1

    def _follows(self, lang: _Language, ids: np.ndarray) -> np.ndarray | None:
        if self.pairs is None:
            return None
        h = lang.hashes[ids]                # what a -1 finds is of no account
        return np.append(_is_marked(self.pairs, pair_bits(h[:-1], h[1:])), False)[:len(ids)]

    def _ids(self, lang: _Language, words: list[bytes]) -> np.ndarray:
        known = lang.ids
        ids = list(map(known.get, words))
        if None in ids:
            for w in set(words).difference(known):
                known[w] = self._id(lang, w)
            ids = map(known.get, words)
        return np.fromiter(ids, np.int64, len(words))

    def add(self, name: str, text: bytes) -> Iterator[tuple]:
        """Counts one text (or several, joined by ``END``); yields the runs
        spilled meanwhile."""
        tail = []
        for part, goes_on in _slices(text.translate(_MAP), self.piece):
            words = tail + [w for w in part.replace(END, b" \xff ").split(b" ") if w]
            if sum(len(g.ids) for g in self.langs.values()) > self.known:
                yield from self.finish()                  # ids are dealt anew
                self.langs = {}
            lang = self.langs.get(name)
            if lang is None:
                lang = self.langs[name] = _Language(name.encode(), self.words)
            keep = self.words - 1 if goes_on else 0
            ids = self._ids(lang, words)
            keys = window_keys(ids, self.words, len(words) - keep, self._follows(lang, ids))
            tail = words[-keep:] if keep else []
            lang.keys.append(keys)
            self.buffered += len(keys)
            if self.buffered >= self.chunk:
                self._settle()
                while self.size > self.limit:
                    yield from self._spill(0.5)

    def finish(self) -> Iterator[tuple]:
        """Spills all that is held."""
        self._settle()
        yield from self._spill(1.0)

    def _settle(self) -> None:
        """Sorts the buffered windows, adds their counts to the tries."""
        for lang in self.langs.values():
            if lang.keys:
                self.size += self._insert(lang.trie, np.concatenate(lang.keys))
                lang.keys = []
        self.buffered = 0

    def _insert(self, trie: HatTrie, keys: np.ndarray) -> int:
        if not len(keys):
            return 0
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        hi, lo = keys[order, 0], keys[order, 1]
        new = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
        counts = np.diff(np.append(new, len(hi))).tolist()
        first = hi[new] >> ID_BITS
        second = (hi[new] & ((1 << ID_BITS) - 1)).tolist()
        shift = (self.words - 2) * ID_BITS
        rests = [(s << shift) | r for s, r in zip(second, lo[new].tolist())]
        cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])).tolist()
        return sum(trie.add(int(first[a]), rests[a:b], counts[a:b])
                   for a, b in zip(cut, [*cut[1:], len(rests)]))

    def _spill(self, share: float) -> Iterator[tuple]:
        """(partition, language, words, windows, counts) of the largest
        subtrees, a sorted run per prefix partition."""
        for name, lang in self.langs.items():
            taken = lang.trie.take(share)
            if taken:
                columns, counts = self._columns(lang.trie, taken)
                self.size -= sum(lang.trie.drop(first) for first in taken)
                for part, run in self._runs(lang, columns, counts):
                    yield part, name, *_pack(*run)

    def _columns(self, trie: HatTrie, firsts: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
        """The windows of subtrees as one array of ids (from 1, 0 for none) per
        word, and their counts."""
        low_bits, mask = (self.words - 2) * ID_BITS, (1 << ID_BITS) - 1
        low_mask = (1 << low_bits) - 1
        first, second, low, counts = [], [], [], []
        for f in firsts:
            for head, held in trie.containers(f):
                n = len(held)
                first.append(np.full(n, f, np.int64))
                if head:                        # the second word is above the container
                    second.append(np.full(n, head >> low_bits, np.int64))
                    low.append(np.fromiter(held, np.int64, n) | (head & low_mask))
                else:
                    second.append(np.fromiter((k >> low_bits for k in held), np.int64, n))
                    low.append(np.fromiter((k & low_mask for k in held), np.int64, n))
                counts.append(np.fromiter(held.values(), np.int64, n))
        low = np.concatenate(low)
        later = [(low >> k * ID_BITS) & mask for k in range(self.words - 3, -1, -1)]
        return [np.concatenate(first), np.concatenate(second), *later], np.concatenate(counts)

    def _runs(self, lang: _Language, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple]:
        """(partition, (words, columns, counts)), both in the order of the words."""
        used = np.flatnonzero(np.bincount(np.concatenate(columns), minlength=1))
        used = used[used > 0]
        names = [lang.names[i - 1] for i in used]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.zeros(used[-1] + 1, np.int64)
        rank[used[order]] = np.arange(1, len(used) + 1)
        hashes = np.zeros(used[-1] + 1, np.uint64)
        hashes[used] = lang.hashes[used - 1]
        mix = np.full(len(counts), lang.seed, np.uint64)
        for c in columns[:3]:
            mix = (mix ^ hashes[c]) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
        part = (mix % np.uint64(self.parts)).astype(np.int64)
        columns = [rank[c] for c in columns]
        keys = _keys([part, *columns])
        order_of = np.lexsort(keys[::-1])
        columns, counts, part = [c[order_of] for c in columns], counts[order_of], part[order_of]
        names = np.array([names[i] for i in order], object)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b in zip(starts, [*starts[1:], len(part)]):
            own = [c[a:b] for c in columns]
            seen = np.zeros(len(names) + 1, bool)
            for c in own:
                seen[c] = True
            seen[0] = False
            local = np.cumsum(seen)             # ids within the run, still in order
            local[0] = 0
            yield int(part[a]), (names[np.flatnonzero(seen) - 1].tolist(), [local[c] for c in own],
                                 counts[a:b])


def _keys(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Two columns (below 2**31) per sort key."""
    return [columns[i] << 31 | columns[i + 1] if i + 1 < len(columns) else columns[i]
            for i in range(0, len(columns), 2)]


def _pack(words: list[bytes], columns: list[np.ndarray], counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A run as compressed columns; no word holds a line end."""
    press = zstandard.ZstdCompressor(1).compress
    return (press(b"\n".join(words)), press(np.stack(columns).astype(np.int32).tobytes()),
            press(counts.astype(np.int64).tobytes()))


def _unpack(words: bytes, windows: bytes, counts: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    grow = zstandard.ZstdDecompressor().decompress
    n = np.frombuffer(grow(counts), np.int64)
    return grow(words).split(b"\n"), np.frombuffer(grow(windows), np.int32).reshape(-1, len(n)), n


def merge_runs(runs: list[tuple], min_count: int) -> Iterator[tuple[bytes, int, int]]:
    """(phrase, words, count) of the phrases of one partition that reach
    ``min_count``, from its sorted runs."""
    names = sorted(set().union(*[words for words, _, _ in runs]))
    id_of = {w: i for i, w in enumerate(names, 1)}
    columns = [[] for _ in runs[0][1]]
    for words, windows, _ in runs:
        to = np.fromiter(map(id_of.__getitem__, words), np.int64, len(words))
        to = np.concatenate([[0], to])          # runs stay sorted: both are in the words' order
        for held, ids in zip(columns, windows):
            held.append(to[ids])
    columns = [np.concatenate(c) for c in columns]
    counts = np.concatenate([n for _, _, n in runs])
    order = np.lexsort(_keys(columns)[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    for k in range(min(len(columns), 3), len(columns) + 1):
        rows = np.flatnonzero(columns[k - 1] > 0)
        if not len(rows):
            continue
        ids = [c[rows] for c in columns[:k]]
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in ids], axis=0)])
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts[rows], starts)
        for i in np.flatnonzero(sums >= min_count):
            yield b" ".join(names[c[starts[i]] - 1] for c in ids), k, int(sums[i])


# ---- counting on Spark -----------------------------------------------------------------
def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f) of all words of (lang, text)."""
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(PIECE_WORD), 0)
    return (texts.select("lang", F.explode(words).alias("word"))
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")))


def bitmap(rows: DataFrame, bit: Column, bits: int) -> bytes:
    """The hashed bits of ``rows`` as a bitmap of a fixed size; at most
    2**bits / 32768 rows of 4 KB reach the driver."""
    rows = (rows.select((bit + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = bytearray(1 << (bits - 3))
    for r in rows:
        out[(r.k - 1) * 4096:r.k * 4096] = r.bits
    return bytes(out)


RUN_SCHEMA = "part long, lang string, words binary, windows binary, counts binary"
COUNT_SCHEMA = "lang string, phrase string, words int, f long, bit long"


def phrase_counts(texts: DataFrame, frequent: DataFrame, min_count: int = MIN_COUNT,
                  max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of 2 to ``max_words`` words seen
    at least ``min_count`` times, given the words seen so often."""
    if not 2 <= max_words <= 5:
        raise ValueError("max_words must be 2 to 5")
    context = texts.sparkSession.sparkContext
    words = context.broadcast(bitmap(frequent, F.pmod(F.xxhash64("lang", "word"), F.lit(1 << WORD_BITS)),
                                     WORD_BITS))
    pairs = stored(window_counts(texts, words, None, 2, min_count), "pairs")
    if max_words == 2:
        return pairs.drop("bit")
    marked = context.broadcast(bitmap(pairs, F.col("bit"), PAIR_BITS))
    longer = stored(window_counts(texts, words, marked, max_words, min_count), "longer")
    return pairs.unionByName(longer).drop("bit")


def window_counts(texts: DataFrame, marked, pairs, max_words: int, min_count: int) -> DataFrame:
    """(lang, phrase, words, f, bit) of the frequent pairs (``max_words`` 2) or
    phrases of three words and more, by tries; ``bit`` is a pair's filter bit.
    ``marked`` and ``pairs`` are the broadcast bitmaps (no pairs: None)."""
    tasks = shuffle_parts(texts.sparkSession)
    parts = tasks * PARTS_PER_TASK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WindowCounter(marked.value, max_words, parts, pairs and pairs.value)

        def batch(runs) -> pa.RecordBatch:
            cols = list(zip(*runs)) or [[]] * 5
            types = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["part", "lang", "words", "windows", "counts"])

        for b in batches:
            joined: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                joined.setdefault(lang, []).append(text)
            for lang, texts_of in joined.items():
                for i in range(0, len(texts_of), 64):
                    runs = list(counter.add(lang, END.join(texts_of[i:i + 64])))
                    if runs:
                        yield batch(runs)
        yield batch(list(counter.finish()))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["lang", "phrase", "words", "f", "bit"]
        key, runs, rows = None, [], []

        def bit(phrase: bytes, seed: int) -> int:
            h = np.array([xxhash.xxh64_intdigest(w, seed) for w in phrase.split(b" ")[:2]], np.uint64)
            return int(pair_bits(h[:1], h[1:])[0])

        def flush():
            seed = _seed(key[1].encode())
            rows.extend((key[1], p.decode(), k, n, bit(p, seed)) for p, k, n in merge_runs(runs, min_count))

        for df in batches:
            for part, lang, *run in df.itertuples(index=False, name=None):
                if (part, lang) != key:
                    if key is not None:
                        flush()
                    key, runs = (part, lang), []
                    if len(rows) > 20_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                runs.append(_unpack(*run))
        if key is not None:
            flush()
        yield pd.DataFrame(rows, columns=names)

    runs = (texts.select("lang", F.col("text").cast("binary").alias("text"))
            .mapInArrow(count, RUN_SCHEMA))
    return (runs.repartition(tasks, "part").sortWithinPartitions("part", "lang")
            .mapInPandas(merge, COUNT_SCHEMA))


# ---- scores ------------------------------------------------------------------------------
# whole-number division of decimals: exact beyond 64 bits
SCORE = (f"cast({SCALE} as decimal(5,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))"
         " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")


def _head(words: Column, k: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(1), k), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n,
    score``. ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at
    the cut with the lowest score ``floor(1000 a n / (l r))``."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = stored(word_counts(texts), "words")
    frequent = words.filter(F.col("f") >= min_count)
    phrases = phrase_counts(texts, frequent, min_count, max_words)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = (phrases.select("lang", "phrase", "f")
              .unionByName(frequent.select("lang", F.col("word").alias("phrase"), "f")))

    w = F.split("phrase", " ")
    cuts = (phrases.select("lang", "phrase", F.col("f").alias("a"), "words",
                           F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _head(w, F.col("k")).alias("left"),
                    F.array_join(F.slice(w, F.col("k") + 1, F.col("words") - F.col("k")), " ")
                    .alias("right")))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cut = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
           .withColumn("score", F.expr(SCORE)))
    best = (cut.groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c"))
            .select("lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score"))

    # every part of two words or more of a longer phrase, with the longer one's count
    inner = (phrases.filter("words > 2")
             .select("lang", F.col("f").alias("longer"), "words", w.alias("w"),
                     F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
             .select("lang", "longer", "w", "m",
                     F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
             .groupBy("lang", F.array_join(F.expr("slice(w, i, m)"), " ").alias("phrase"))
             .agg(F.max("longer").alias("longer")))
    left_over = (best.join(inner, ["lang", "phrase"], "left")
                 .filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True))).drop("longer"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    few = (left_over.withColumn("g", group)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "g").orderBy(*order)))
           .filter(F.col("rank") <= top))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (few.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
