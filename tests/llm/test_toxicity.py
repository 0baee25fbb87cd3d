"""Compression-distance toxicity: evidence and windows against slow forms, phrases, odd texts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import toxicity as T

PHRASE = "please go and see the old house by the river".split()


def world(seed: int, n: int, first_id: int, toxic_share: float):
    """Texts of ordinary words. The toxic ones end in a phrase whose words all
    texts hold, each elsewhere."""
    rng = random.Random(seed)
    vocab = ["".join(random.Random(i).choices("abcdefghijklmnop", k=3 + i % 6)) for i in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        toxic = rng.random() < toxic_share
        if toxic:
            words += PHRASE
        else:
            for w in PHRASE:
                words.insert(rng.randrange(len(words) + 1), w)
        rows.append((first_id + i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def phrase_rows():
    return world(1, 1500, 0, 0.25)


def test_phrase_of_ordinary_words(spark, phrase_rows):
    clash = [(i, t, y, 0.5, "x") for i, t, y in phrase_rows]
    docs = spark.createDataFrame(clash, "doc_id long, text string, toxic int, score double, held_out string")
    labels = spark.createDataFrame([(i, y) for i, _, y in phrase_rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.classify(docs, labels).collect()}
    held = [(got[i].predicted, y) for i, _, y in phrase_rows if got[i].held_out]
    assert np.mean([p for p, y in held if y]) >= 0.95
    assert np.mean([p for p, y in held if not y]) <= 0.02


def test_counts_against_plain_sets(phrase_rows):
    texts = [t.split() for _, t, _ in phrase_rows[:60]] + [[], ["a"], ["a", "b"], ["a", "b", "c"]]
    names = {"": 0}
    ids = [np.array([names.setdefault(w, len(names)) for w in t], np.uint64) for t in texts]
    pairs = {(w, p) for t in texts for p, w in zip(["", *t], t)}
    want = Counter(names[w] for w, _ in pairs)
    got = T.word_counts(ids)
    assert dict(zip(got.things.tolist(), got.contexts.tolist())) == dict(want)
    far = {(tuple(t[i:i + T.PHRASE]), t[max(0, i - T.REACH)])
           for t in texts for i in range(len(t) - T.PHRASE + 1)}
    want = Counter(p for p, _ in far)
    got = T.phrase_counts(ids)
    assert sorted(got.contexts.tolist()) == sorted(want.values())
    for phrase, n in list(want.items())[:200]:
        key = T._phrases(np.array([names[w] for w in phrase], np.uint64))
        assert got.of(key).tolist() == [n]


def test_runs():
    names = [b"", b"a", b"b", b"c", b"d", b"x"]
    t = np.array([5, 1, 2, 3, 5, 5, 4, 4, 5], np.uint64)
    phrases = T._phrases(np.array([1, 2, 3], np.uint64))
    assert T.runs([t], names, np.array([4], np.uint64), phrases) == [b" a b c ", b" d "]
    assert T.runs([t[:0]], names, np.array([4], np.uint64), phrases) == []


def test_gaps_and_evidence_against_slow_form(phrase_rows):
    toxic = [t for _, t, y in phrase_rows if y][:150]
    gauge = T.Gauge(*T.dictionaries(toxic, [t for _, t, y in phrase_rows if not y][:400]))
    for text in [toxic[0], "one", "a, b c! d (e) f g h i j k. l m ... n o p q r s t u v", "", None, "x" * 1000, "\u6bd2" * 300]:
        words = [p for w in (text or "").encode().lower().split()
                 for p in ([b""] if not w.strip(T.EDGES) else (
                     w.strip(T.EDGES)[i:i + T.LONG_WORD] for i in range(0, len(w.strip(T.EDGES)), T.LONG_WORD)))]
        twelves, at = [], 0
        while words:
            twelves.append(b" ".join(words[at:at + 12]))
            if at + 12 >= len(words):
                break
            at += 8
        want = []
        for wins in (words, twelves):
            padded = [gauge.prime + w + gauge.tail for w in wins]
            want.append([len(gauge.ordinary(p)) - len(gauge.toxic(p)) for p in padded])
        got = gauge.gaps(text)
        assert [g.tolist() for g in got] == want
        slow = []
        for gaps, levels in zip(want, T.LEVELS):
            over = [max(0, sum(g >= x for g in gaps) - sum(g <= -x for g in gaps)) for x in levels]
            slow += [(o / max(1, len(gaps))) ** 0.5 for o in over] + [np.log1p(o) for o in over]
            slow += [min(max([0, *gaps]), 2 * levels[-1]), np.log1p(len(gaps))]
        assert np.allclose(T.evidence(got), slow)
    assert max(max(g) for g in gauge.gaps(" ".join(PHRASE))) >= 6


def test_very_long_text(spark, phrase_rows):
    """A text of over 1 MiB is scored whole: what is toxic in it stands at its end."""
    plain = [t for _, t, y in phrase_rows if not y]
    y = np.array([y == 1 for _, _, y in phrase_rows])
    model = T.fit([t for _, t, _ in phrase_rows], y, np.arange(len(y)) % 2 == 0, 1.0)
    gauge = T.Gauge(model.toxic, model.ordinary)
    long = " ".join(plain) * 3
    assert len(long) > 1 << 20
    tail = long + (" " + " ".join(PHRASE)) * 5
    tops = [max(int(g.max()) for g in gauge.gaps(t)) for t in (long, tail)]
    assert tops[1] >= tops[0] and T.score(model, gauge, tail) > T.score(model, gauge, long)
    docs = spark.createDataFrame([(1, tail), (1, tail), (2, None)], "doc_id long, text string")
    got = docs.select("doc_id", T.score_column(spark, model, F.col("text")).alias("s")).collect()
    assert {r.s for r in got if r.doc_id == 1} == {T.score(model, gauge, tail)}


def test_words_in_use_stay_known(monkeypatch):
    """A word that every text holds is compressed once, however many others come and go."""
    monkeypatch.setattr(T, "CACHE", 100)
    gauge = T.Gauge(b"bad words here " * 40, b"plain words there " * 40)
    seen, toxic = [], gauge.toxic
    gauge.toxic = lambda x: seen.append(x) or toxic(x)
    texts = [" ".join(["common", *(f"w{i}x{k}" for k in range(20))]) for i in range(40)]
    got = [gauge.gaps(t)[0].tolist() for t in texts]
    assert seen.count(gauge.prime + b"common" + gauge.tail) == 1
    assert len(gauge.known) + len(gauge.older) <= 100 + 2 * 21
    assert got == [T.Gauge(b"bad words here " * 40, b"plain words there " * 40).gaps(t)[0].tolist()
                   for t in texts]


class Looks(dict):
    """Counts how often it is looked into."""
    n = 0

    def get(self, x):
        self.n += 1
        return super().get(x)

    def __contains__(self, x):
        self.n += 1
        return super().__contains__(x)

    def __getitem__(self, x):
        self.n += 1
        return super().__getitem__(x)


def test_known_word_is_looked_for_once():
    gauge = T.Gauge(b"bad words here " * 40, b"plain words there " * 40)
    text = "some plain words here, and some bad words there"
    first, words = gauge.gaps(text), T._words(text)
    gauge.known = Looks(gauge.known)
    again = gauge.gaps(text)
    assert [g.tolist() for g in again] == [g.tolist() for g in first]
    assert gauge.known.n == len(words)


def test_training_splits_each_text_once(monkeypatch, phrase_rows):
    """Dictionaries are made three times from the same texts; those of rows alone
    are those made beside the other texts."""
    texts, y = [t for _, t, _ in phrase_rows], np.array([y == 1 for _, _, y in phrase_rows])
    seen, split = Counter(), T._words
    monkeypatch.setattr(T, "_words", lambda t: seen.update([t]) or split(t))
    model = T.fit(texts, y, np.arange(len(y)) % 2 == 0, 1.0)
    assert set(seen.values()) == {1} and len(seen) == len(set(texts))
    bad, plain = ([t for t, toxic in zip(texts, y) if toxic == side] for side in (True, False))
    assert T.dictionaries(bad, plain) == (model.toxic, model.ordinary)


def test_scores_do_not_depend_on_what_is_scored_together(monkeypatch, phrase_rows):
    texts, y = [t for _, t, _ in phrase_rows], np.array([y == 1 for _, _, y in phrase_rows])
    model = T.fit(texts, y, np.arange(len(y)) % 2 == 0, 1.0)
    some = [*texts[:300], None, "", " . ", "one", texts[0] * 20]
    gauge = T.Gauge(model.toxic, model.ordinary)
    alone = [T.score(model, gauge, t) for t in some]
    for together in (1, 500, 1 << 30):
        monkeypatch.setattr(T, "TOGETHER", together)
        assert T.scores(model, gauge, some).tolist() == alone
    assert T.scores(model, gauge, []).tolist() == []
