"""Quality classifier: naive Bayes support vectors (operator 4).

Features: indicators of hashed n-grams of the whole text (single words, pairs
of neighbouring words, three-byte sequences, and n-grams that only tell how many
of n words repeat the word before them), ``2 ** BITS`` of them. Each
indicator is scaled by its class log-count ratio, rows are brought to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent and
interpolated with its mean weight as in the method's paper.

Scale: the model is fitted on a hash sample of the labelled rows, at most about
``SAMPLE_ROWS`` of them, half of each class where there are enough: the
documented bound. Their features are made where the texts are and only they
meet in the one task that fits; a fifth of the sample calibrates the margin
(Platt). What the driver holds and ships is two arrays of ``2 ** BITS`` floats,
whatever the corpus. Scoring is one pass over all whole texts, no shuffle.

Defined results: a null text counts as empty; an empty text has the bias
feature only and gets the score the model gives it; without labelled rows of
both classes every score is 1 (nothing is known against any document); rows
with a null label or id teach nothing. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import id_fold, labelled_sample

BITS = 18
SIZE = 1 << BITS
SAMPLE_ROWS = 8000
EPOCHS = 8
COST = 1.0
BLEND = 0.75            # weight of the fitted model against its mean weight
THRESHOLD = 0.3
RUNS = (2, 4, 8)        # words in a row whose repeat marks make an n-gram
PIECE = 1 << 20         # bytes hashed at a time

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _fold(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * _ODD
    h ^= h >> np.uint64(29)
    return (h * _ODD) >> np.uint64(64 - BITS)


def _piece_flags(a: np.ndarray, flags: np.ndarray) -> int:
    """Marks the features of ``a``, whole words; returns where the words start
    that the next piece has to begin with."""
    space, again = _SPACE[a], 0
    inside = np.flatnonzero(~space)
    if len(inside):
        head = np.flatnonzero(np.r_[True, np.diff(inside) > 1])
        if len(head) > max(RUNS):
            again = int(inside[head[-max(RUNS)]])
        place = np.arange(len(inside)) - np.repeat(head, np.diff(np.r_[head, len(inside)]))
        value = (a[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255]
        word = np.add.reduceat(value, head)
        mark = word.copy()
        mark[1:][word[1:] == word[:-1]] = np.uint64(1)
        flags[_fold(word, 1)] = True
        if len(word) > 1:
            pair = word[:-1] * np.uint64(31) + mark[1:]
            pair[mark[1:] == 1] = np.uint64(7)
            flags[_fold(pair, 2)] = True
        same = np.cumsum(mark == 1)
        for n in RUNS:                                  # n-grams of repeat marks
            if len(same) > n:
                seen = np.flatnonzero(np.bincount(same[n:] - same[:-n], minlength=1))
                flags[_fold(seen.astype(np.uint64) + np.uint64(n * 100), 3)] = True
    if len(a) > 2:
        b = a.astype(np.uint32)
        tri = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        flags[_fold(tri.astype(np.uint64), 4)] = True
    return again


def _word_end(a: np.ndarray, at: int) -> int:
    """The first break at or after ``at``."""
    while at < len(a):
        space = _SPACE[a[at:at + PIECE]]
        if space.any():
            return at + int(space.argmax())
        at += PIECE
    return len(a)


def features(text: str | None) -> np.ndarray:
    """Sorted feature numbers present in the text; number 0 is the bias."""
    a = np.frombuffer((text or "").encode(), np.uint8)
    flags = np.zeros(SIZE, bool)
    # very long texts go through in pieces of whole words that begin with the
    # last words of the piece before: the same features as in one piece
    start = end = 0
    while end < len(a):
        end = _word_end(a, end + PIECE)
        start += _piece_flags(a[start:end], flags)
    flags[0] = True
    return np.flatnonzero(flags)


def log_ratios(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    p, q = pos + 1.0, neg + 1.0
    r = np.log((p / p.sum()) / (q / q.sum()))
    r[0] = 1.0
    return r


def descend(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: float = COST,
            epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights of the hinge-loss model over unit-length rows of ``r`` at the
    given features, by dual coordinate descent."""
    w = np.zeros(len(r))
    alpha = np.zeros(len(rows))
    scaled = [r[f] / max(1e-12, np.sqrt((r[f] ** 2).sum())) for f in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], scaled[i]
            g = y[i] * (w[f] @ x) - 1.0
            new = min(max(alpha[i] - g, 0.0), cost)      # unit rows: the step is g itself
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    return w


def platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(a, b) of ``1 / (1 + exp(-(a m + b)))`` by Newton steps with smoothed targets."""
    n1, n0 = good.sum(), len(good) - good.sum()
    t = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1e-9, float(np.abs(margin).max(initial=0.0)))
    m, ab = margin / scale, np.array([1.0, 0.0])
    x = np.stack([m, np.ones_like(m)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
        grad = x @ (p - t) + 1e-6 * ab
        hess = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(ab[0] / scale), float(ab[1])


def fit_rows(rows: list[np.ndarray], good: np.ndarray, r: np.ndarray,
             held: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(feature weights to apply to ``r`` at the features, a, b)."""
    fit = np.flatnonzero(~held)
    w = descend([rows[i] for i in fit], np.where(good[fit], 1.0, -1.0), r)
    w = BLEND * w + (1 - BLEND) * np.abs(w).mean()
    margins = np.array([margin(rows[i], w, r) for i in np.flatnonzero(held)])
    return w, *platt(margins, good[held])


def margin(f: np.ndarray, w: np.ndarray, r: np.ndarray) -> float:
    x = r[f]
    return float((w[f] @ x) / max(1e-12, np.sqrt((x * x).sum())))


# ---- Spark ---------------------------------------------------------------------------
def _features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"h": pdf["h"], "y": pdf["y"],
                            "f": [features(t).astype("<i4").tobytes() for t in pdf["text"]]})


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(batches)
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True).sort_values(["h", "y"], kind="stable")
    rows = [np.frombuffer(b, "<i4") for b in pdf["f"]]
    good, held = pdf["y"].to_numpy() == 1, pdf["h"].to_numpy() % 5 == 0
    counts = np.zeros((2, SIZE))
    for f, y, h in zip(rows, good, held, strict=True):
        if not h:                                   # rows that calibrate teach nothing else
            counts[int(y), f] += 1
    if {*good[held]} == {*good[~held]} == {True, False}:
        r = log_ratios(counts[1], counts[0])
        w, a, b = fit_rows(rows, good, r, held)
        yield pd.DataFrame({"w": [w.astype("<f8").tobytes()], "r": [r.astype("<f8").tobytes()],
                            "a": [a], "b": [b]})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5,
          held_fold: int = 0, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
          text_col: str = "text"):
    """(weights, ratios, a, b) or None if a class has no labelled row. Labels
    of the fold ``held_fold`` are not used."""
    rows, have = labelled_sample(docs, labels, label_col, folds, held_fold,
                                 {0: sample_rows // 2, 1: sample_rows // 2}, id_col, text_col)
    if len(have) < 2:
        return None
    got = (rows.mapInPandas(_features_of, "h long, y int, f binary").repartition(1)
           .mapInPandas(_fit, "w binary, r binary, a double, b double").collect())
    if not got:
        return None
    m = got[0]
    return np.frombuffer(m.w, "<f8"), np.frombuffer(m.r, "<f8"), m.a, m.b


def score_column(spark: SparkSession, model, text: Column) -> Column:
    """Score, 0 to 1, of a text column under a trained model."""
    if model is None:
        return F.lit(1.0)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def nbsvm_score(texts: pd.Series) -> pd.Series:
        w, r, a, b = sent.value
        z = np.array([a * margin(features(t), w, r) + b for t in texts], dtype=float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -60, 60))))
    return nbsvm_score(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    out = docs.select(F.col(id_col).alias("doc_id"),
                      (id_fold(F.col(id_col), 5) == 0).alias("held_out"),
                      score_column(docs.sparkSession, model, F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    return docs.filter(score_column(docs.sparkSession, model, F.col(text_col)) >= THRESHOLD)
