"""Toxicity by compression distance (operator 2).

Two zstandard dictionaries are trained, one on toxic and one on ordinary text,
each on the runs of words that its side brings beyond what both share: the
toxic one on runs of words and of ``PHRASE``-word phrases that are typical of
toxic documents (met in many different contexts there and rarely in ordinary
ones, so copies of one document count once), the ordinary one on runs of its
less common words. Behind both stands the same base, the most widely used
ordinary words, so neutral text costs the same under both.

Every text is cut into single words and into windows of twelve words, eight
apart, so that any five neighbours meet in one (``WINDOWS``). Words lose the
punctuation around them (``EDGES``); one of more than ``LONG_WORD`` bytes counts as
several. A window is compressed under both dictionaries between two passages out of the
common base, without which so short an input would be stored as it is and its
end not be searched; the difference of the two lengths is the window's gap in
bytes. A document's evidence are, for either kind of window, the numbers and
shares of windows whose gap reaches each of ``LEVELS``, and the largest gap; a
logistic model calibrates them to a probability, on documents that the
dictionaries it sees them under were not trained on.

Scale: training uses a hash sample of the labelled rows, at most about
``SAMPLE_TOXIC`` and ``SAMPLE_ORDINARY`` documents (the documented bound), in
one task. The driver ships two dictionaries of ``BASE_BYTES + TYPICAL_BYTES``
and a handful of numbers. Scoring is one pass over all whole texts, no shuffle;
a worker keeps
the gaps of up to ``CACHE`` words, and forgets those it has not met for longest.

Defined results: null, empty and blank texts have no window and get the score
of a document without evidence; without labelled rows of both classes every
score is 0. Texts of any length are scored whole; repeated rows get equal
scores. Only id and text are read, so further columns may have any name; rows
with a null id or label teach nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import id_fold, labelled_sample

SAMPLE_TOXIC = 2500
SAMPLE_ORDINARY = 5000
WINDOWS = ((1, 1), (12, 8))  # words, and words from one window to the next
LONG_WORD = 64               # bytes
CACHE = 800_000
TOGETHER = 100_000           # words whose gaps become evidence at once
BASE_BYTES = 16 * 1024
TYPICAL_BYTES = 8 * 1024
SEGMENT, MATCH = 32, 8       # bytes of a trained segment, and of what is counted in it
PRIME_BYTES = 64             # of the base, before a window
TAIL_BYTES = 16              # of the base, after it
PHRASE = 3
REACH = 16                   # words from a phrase back to its context
MIN_CONTEXTS = 5
MIN_RATIO = 10.0
LEVELS = ((1, 2, 3, 4, 5, 6), (2, 4, 6, 8, 10, 12, 16))
THRESHOLD = 0.7
EDGES = b'.,!?;:|"()'


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray


def _words(text: str | None) -> list[bytes]:
    words = [w.strip(EDGES) for w in (text or "").encode().lower().split()]
    if words and max(map(len, words)) > LONG_WORD:
        words = [w[i:i + LONG_WORD] for w in words for i in range(0, max(1, len(w)), LONG_WORD)]
    return words


def windows(words: list[bytes], size: int, step: int) -> list[bytes]:
    """Runs of ``size`` words, ``step`` apart, up to the text's last word."""
    if size == 1 or not words:
        return words
    return [b" ".join(words[i:i + size]) for i in range(0, max(1, len(words) - size + step), step)]


class Counts(NamedTuple):
    """Things (ascending) and the number of different contexts of each."""
    things: np.ndarray
    contexts: np.ndarray

    def of(self, things: np.ndarray) -> np.ndarray:
        if not len(self.things):
            return np.zeros(len(things), np.int64)
        at = np.minimum(np.searchsorted(self.things, things), len(self.things) - 1)
        return np.where(self.things[at] == things, self.contexts[at], 0)


_ODD = np.random.default_rng(11).integers(0, 1 << 63, PHRASE + 2, dtype=np.uint64) * 2 + 1


def _phrases(ids: np.ndarray) -> np.ndarray:
    """A 64-bit key of every ``PHRASE`` neighbouring words."""
    n = max(0, len(ids) - PHRASE + 1)
    return sum((ids[i:i + n] * _ODD[i] for i in range(PHRASE)), np.zeros(n, np.uint64))


def _count(things: list[np.ndarray], contexts: list[np.ndarray]) -> Counts:
    things = np.concatenate([np.zeros(0, np.uint64), *things])
    contexts = np.concatenate([np.zeros(0, np.uint64), *contexts])
    first = np.unique(things * _ODD[-1] + contexts * _ODD[-2], return_index=True)[1]
    return Counts(*np.unique(things[first], return_counts=True))


def word_counts(texts: list[np.ndarray]) -> Counts:
    """Number of different words that each word follows."""
    return _count(texts, [np.r_[np.zeros(1, np.uint64), t][:len(t)] for t in texts])


def phrase_counts(texts: list[np.ndarray]) -> Counts:
    """Number of different words that stand ``REACH`` words before each phrase
    (the text's first word where it is nearer)."""
    keys = [_phrases(t) for t in texts]
    return _count(keys, [t[np.maximum(np.arange(len(k)) - REACH, 0)] for t, k in zip(texts, keys, strict=True)])


def typical(here: Counts, there: Counts) -> np.ndarray:
    odds = there.contexts.sum() / max(1, here.contexts.sum())
    ok = ((here.contexts >= MIN_CONTEXTS)
          & (odds * here.contexts >= MIN_RATIO * (there.of(here.things) + 1)))
    return here.things[ok]


def runs(texts: list[np.ndarray], names: list[bytes], words: np.ndarray,
         phrases: np.ndarray) -> list[bytes]:
    """The longest runs that such words and phrases make; a word that repeats
    the one before is left out."""
    out, wanted = [], np.zeros(len(names), bool)
    wanted[words.astype(np.int64)] = True
    for t in texts:
        t = t[np.r_[True, t[1:] != t[:-1]]] if len(t) else t
        on = wanted[t.astype(np.int64)]
        if len(phrases):
            for i in np.flatnonzero(np.isin(_phrases(t), phrases)):
                on[i:i + PHRASE] = True
        edges = np.flatnonzero(np.diff(np.r_[False, on, False].astype(np.int8)))
        out += [b" " + b" ".join(names[x] for x in t[i:j]) + b" "
                for i, j in zip(edges[::2], edges[1::2], strict=True)]
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train
    on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=MATCH).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sorted(set(samples)))[-size:]


def _fill(words: list[bytes], size: int) -> list[bytes]:
    ends = np.cumsum([len(w) + 1 for w in words])
    return words[:int(np.searchsorted(ends, size, side="right"))]


class Numbered:
    """Texts as numbers of their words, each text split once."""

    def __init__(self, texts: list[str]):
        self.number: dict[bytes, int] = {b"": 0}
        self.ids = {t: self._ids(_words(t)) for t in sorted(set(texts))}
        self.names = list(self.number)
        self.long = np.array([len(w) > 2 for w in self.names])

    def _ids(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        for w in words:
            if w not in number:
                number[w] = len(number)
        return np.fromiter(map(number.__getitem__, words), np.uint64, len(words))

    def words(self, text: str) -> list[bytes]:
        return list(map(self.names.__getitem__, self.ids[text].tolist()))


def dictionaries(toxic: list[str], ordinary: list[str], texts: Numbered | None = None) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary; the common base lies at their
    ends, where matches cost least. ``texts`` may hold further texts."""
    texts = texts or Numbered(toxic + ordinary)
    names, long = texts.names, texts.long
    bad, plain = ([texts.ids[t] for t in sorted(set(side))] for side in (toxic, ordinary))
    here, there = word_counts(bad), word_counts(plain)
    words = typical(here, there)
    words = words[long[words]]
    found = runs(bad, names, words, typical(phrase_counts(bad), phrase_counts(plain)))
    mark = trained(found, TYPICAL_BYTES)
    ok = long[there.things] & ~np.isin(there.things, words)
    room = (BASE_BYTES + len(mark)) // 4 + 2            # a word takes four bytes at least
    common = [w for _, w in heapq.nsmallest(
        room, ((-n, names[x]) for x, n in zip(there.things[ok].tolist(), there.contexts[ok].tolist(), strict=True)))]
    base = _fill(common, BASE_BYTES)
    rest = np.array([texts.number[w] for w in _fill(common[len(base):], len(mark))], np.uint64)
    others = runs(plain, names, rest, np.zeros(0, np.uint64))
    end = b" " + b" ".join(reversed(base)) + b" "
    return mark + end, trained(others, max(256, len(mark))) + end


class Gauge:
    """Gaps of a text's windows between two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.prime = ordinary[-PRIME_BYTES:]
        self.tail = b" " + self.prime[:TAIL_BYTES]
        params = zstandard.ZstdCompressionParameters(
            window_log=16, chain_log=16, hash_log=15, search_log=6, min_match=4, target_length=64,
            strategy=zstandard.STRATEGY_BTLAZY2, write_checksum=0, write_content_size=0,
            write_dict_id=0)
        self.toxic, self.ordinary = (
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(
                d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params).compress
            for d in (toxic, ordinary))
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}       # met before ``known`` was begun

    def gaps(self, text: str | None) -> list[np.ndarray]:
        """The gaps of a text's windows, for each kind of window."""
        return self.gaps_of(_words(text))

    def gaps_of(self, words: list[bytes]) -> list[np.ndarray]:
        out = []
        for size, step in WINDOWS:
            found = (self.known, self.older) if size == 1 else ({}, {})
            out.append(np.array(self._look(windows(words, size, step), *found), np.int64))
        if len(self.known) > CACHE // 2:        # words still in use move on
            self.known, self.older = {}, self.known
        return out

    def _look(self, w: list[bytes], known: dict[bytes, int], older: dict[bytes, int]) -> list[int]:
        toxic, ordinary, prime, tail = self.toxic, self.ordinary, self.prime, self.tail
        gaps = list(map(known.get, w))          # one look for a word that is known
        for i, gap in enumerate(gaps):
            if gap is None:
                x = w[i]
                gap = known.get(x)
                if gap is None:
                    gap = older.get(x)
                    if gap is None:
                        y = prime + x + tail
                        gap = len(ordinary(y)) - len(toxic(y))
                    known[x] = gap
                gaps[i] = gap
        return gaps


@lru_cache(maxsize=1)
def gauge_of(toxic: bytes, ordinary: bytes) -> Gauge:
    """One gauge per Python worker: the next task finds the gaps of common words."""
    return Gauge(toxic, ordinary)


def evidence_of(texts: list[list[np.ndarray]]) -> np.ndarray:
    """A row of evidence for the gaps of each text."""
    out = []
    for kind, levels in enumerate(LEVELS):
        end, at = levels[-1], np.array(levels)
        width, sizes = 4 * end + 1, np.array([len(t[kind]) for t in texts])
        g = np.concatenate([t[kind] for t in texts])
        place = np.repeat(np.arange(len(texts)) * width + 2 * end, sizes) + np.clip(g, -2 * end, 2 * end)
        counts = np.bincount(place, minlength=len(texts) * width).reshape(-1, width)
        upwards, downwards = counts[:, ::-1].cumsum(axis=1)[:, ::-1], counts.cumsum(axis=1)
        over = np.maximum(upwards[:, 2 * end + at] - downwards[:, 2 * end - at], 0).astype(float)
        top = (upwards[:, 2 * end + 1:] > 0).sum(axis=1)        # the largest gap, from 0 to 2 * end
        out += [np.sqrt(over / np.maximum(1, sizes)[:, None]), np.log1p(over), np.c_[top, np.log1p(sizes)]]
    return np.concatenate(out, axis=1)


def evidence(gaps: list[np.ndarray]) -> np.ndarray:
    return evidence_of([gaps])[0]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    w, pen = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(hess, x.T @ (p - y) + pen * w)
        w -= np.clip(step, -3, 3)
    return w


def fit(texts: list[str], y: np.ndarray, half: np.ndarray, odds: float) -> Model:
    """Dictionaries of all rows. The logistic model learns from evidence that
    each half (``half``, boolean) shows under dictionaries of the other one.
    ``odds`` is the share of toxic to ordinary labels in the whole divided by
    that in the sample."""
    numbered = Numbered(texts)

    def pair(rows) -> tuple[bytes, bytes]:
        return dictionaries([texts[i] for i in rows if y[i]], [texts[i] for i in rows if not y[i]], numbered)

    x = np.zeros((len(texts), sum(2 * len(levels) + 2 for levels in LEVELS)))
    for side in (half, ~half):
        gauge = Gauge(*pair(np.flatnonzero(~side)))
        for i in np.flatnonzero(side):
            x[i] = evidence(gauge.gaps_of(numbered.words(texts[i])))
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = logistic((x - centre) / spread, y.astype(float))
    w[-1] += np.log(odds)
    return Model(*pair(np.arange(len(texts))), w, centre, spread)


def scores(model: Model, gauge: Gauge, texts: Iterable[str | None]) -> np.ndarray:
    """The scores of texts; the gaps of about ``TOGETHER`` words are held at once."""
    out, held, size = [np.zeros(0)], [], 0

    def some() -> np.ndarray:
        x = (evidence_of(held) - model.centre) / model.spread
        total = (x * model.weights[:-1]).sum(axis=1) + model.weights[-1]  # row by row: equal texts, equal scores
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))
    for t in texts:
        held.append(gauge.gaps(t))
        size += len(held[-1][0])
        if size >= TOGETHER:
            out.append(some())
            held, size = [], 0
    if held:
        out.append(some())
    return np.concatenate(out)


def score(model: Model, gauge: Gauge, text: str | None) -> float:
    return float(scores(model, gauge, [text])[0])


# ---- Spark --------------------------------------------------------------------------
def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 3,
          held_fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    rows, have = labelled_sample(docs, labels, label_col, folds, held_fold,
                                 {0: SAMPLE_ORDINARY, 1: SAMPLE_TOXIC}, id_col, text_col)
    if len(have) < 2:
        return None

    def fit_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values(["h", "text"], kind="stable")
        y, half = pdf["y"].to_numpy() == 1, pdf["h"].to_numpy() % 2 == 0
        if {*y[half]} == {*y[~half]} == {True, False}:
            m = fit(pdf["text"].tolist(), y, half,
                    have[1] / have[0] / (y.sum() / (~y).sum()))
            yield pd.DataFrame({"t": [m.toxic], "o": [m.ordinary], "w": [m.weights.tolist()],
                                "c": [m.centre.tolist()], "s": [m.spread.tolist()]})

    got = rows.repartition(1).mapInPandas(
        fit_task, "t binary, o binary, w array<double>, c array<double>, s array<double>").collect()
    if not got:
        return None
    m = got[0]
    return Model(bytes(m.t), bytes(m.o), np.array(m.w), np.array(m.c), np.array(m.s))


def score_column(spark: SparkSession, model: Model | None, text: Column) -> Column:
    if model is None:
        return F.lit(0.0)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        gauge = gauge_of(m.toxic, m.ordinary)
        for texts in batches:
            yield pd.Series(scores(m, gauge, texts))
    return toxicity(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    out = docs.select(F.col(id_col).alias("doc_id"),
                      (id_fold(F.col(id_col), 3) == 1).alias("held_out"),
                      score_column(docs.sparkSession, model, F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
