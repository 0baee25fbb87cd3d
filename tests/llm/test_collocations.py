"""Operator 11 against brute force, its trie with tiny bounds, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import collocations as C

from .conftest import SCHEMA, frame

SPLIT, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [WORD.findall(p) for p in SPLIT.split(low)]


def brute(rows, min_count, top, longest=5):
    """rows: (text, lang)"""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        best, longer = [], Counter()
        for q, b in cand.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longer[q[i:i + m]] = max(longer[q[i:i + m]], b)
        for p, a in cand.items():
            cuts = [(1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if longer[p] >= a:
                continue
            best.append((-score, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(best)[:top], 1):
            out.add((lang, rank, phrase.decode(), a, left, right, n[lang], score))
    return out


def mined(df, **kw):
    got = [tuple(r) for r in C.collocations(df, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "b", "Cc", "dé", "e\x01", "f", "的", "g-h"]
    marks = [" ", " ", " ", "\t", ". ", ",", "\n", "?!", "  ", " \x0b"]
    return ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(120)))
            for _ in range(n)]


@pytest.mark.parametrize("seed,longest", [(1, 5), (2, 3), (3, 4), (4, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, longest):
    monkeypatch.setattr(C, "PARTS_PER_TASK", 2)
    rows = [(t, ["x", "y", None][i % 3]) for i, t in enumerate(random_texts(seed))]
    df = frame(spark, [(i, t, lang, None, 0) for i, (t, lang) in enumerate(rows)])
    assert mined(df, min_count=4, top=25, max_words=longest) == brute(rows, 4, 25, longest)


def test_odd_rows_clashes_and_empty(spark, odd_docs, empty_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    want = brute(rows, 3, 2000)
    assert mined(odd_docs, min_count=3) == want and any(r[0] == "en" for r in want)
    extra = odd_docs.withColumn("word", F.lit(1)).withColumn("n", F.lit("n")).withColumn("phrase", F.lit(2))
    assert mined(extra, min_count=3) == want
    assert C.collocations(empty_docs).count() == 0
    with pytest.raises(ValueError):
        C.collocations(odd_docs, max_words=7)


def test_products_beyond_64_bits(spark):
    """1000 a n and l r are beyond 64 bits; the quotient is exact."""
    n, a, l, r = 9_000_000_000_000_001, 3_000_000_007, 4_000_000_009, 5_000_000_021
    assert 1000 * a * n > 1 << 64 < l * r
    df = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    got = df.select(F.expr(C.SCORE).alias("s")).first().s
    assert got == 1000 * a * n // (l * r)


ALL_WORDS = b"\xff" * (1 << (C.WORD_BITS - 3))


def count_with(texts, words, **kw):
    """The counter and merge alone, all words marked."""
    counter = C.WindowCounter(ALL_WORDS, words, 7, **kw)
    runs = [r for t in texts for r in counter.add("x", t.encode())] + list(counter.finish())
    assert counter.size == 0 and all(len(g.trie.root) == 0 for g in counter.langs.values())
    held = defaultdict(list)
    for part, _, *run in runs:
        words, windows, counts = C._unpack(*run)
        assert words == sorted(set(words)) and windows.T.tolist() == sorted(windows.T.tolist())
        held[part].append((words, windows, counts))
    total = Counter()
    for part in held.values():
        for phrase, _, n in C.merge_runs(part, 1):
            total[phrase.decode()] += n
    return total, len(runs)


@pytest.mark.parametrize("bounds", [{}, {"limit": 5, "chunk": 7}, {"limit": 50, "chunk": 20, "known": 3},
                                    {"piece": 3, "limit": 9, "chunk": 4}, {"piece": 1}])
@pytest.mark.parametrize("words", [2, 5])
def test_small_bounds_change_nothing(monkeypatch, bounds, words):
    monkeypatch.setattr(C, "BURST", 3)
    texts = random_texts(9, 12)
    want = Counter()
    for t in texts:
        for w in pieces(t):
            for m in [2] if words == 2 else [3, 4, 5]:
                want.update(" ".join(w[i:i + m]) for i in range(len(w) - m + 1))
    got, runs = count_with(texts, words, **bounds)
    assert got == want
    assert "limit" not in bounds or runs > 7


def test_trie_bursts_and_gives_back_whole_subtrees(monkeypatch):
    monkeypatch.setattr(C, "BURST", 2)
    trie, rng, want = C.HatTrie(5), random.Random(4), Counter()
    for _ in range(400):
        first, ids = rng.randrange(3), [rng.randrange(1, 4) for _ in range(4)]
        rest = 0
        for i in ids:
            rest = rest << C.ID_BITS | i
        trie.add(first, [rest], [2])
        want[first, rest] += 2
    def held(first):
        return {(first, head | k): n for head, c in trie.containers(first) for k, n in c.items()}

    assert {k: n for f in trie.root for k, n in held(f).items()} == dict(want)
    assert trie.size == len(want) and any(type(h) is C.HatTrie.Node for h in trie.root.values())
    taken = trie.take(0.4)
    windows = sum(len(held(f)) for f in taken)
    assert 0.4 * len(want) <= windows < len(want)
    assert sum(trie.drop(f) for f in taken) == windows and trie.size == len(want) - windows


def test_unmarked_words_and_pairs_end_a_window():
    none = C.WindowCounter(bytes(1 << (C.WORD_BITS - 3)), 5, 3)
    assert list(none.add("x", b"a b c d")) + list(none.finish()) == []
    seed = C._seed(b"x")
    h = [np.array([C.xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in (b"a", b"b", b"c", b"d", b"e")]
    bits = bytearray(1 << (C.PAIR_BITS - 3))
    for i in (0, 1, 3):                                 # not: c d
        bit = int(C.pair_bits(h[i], h[i + 1])[0])
        bits[bit >> 3] |= 1 << (bit & 7)
    counter = C.WindowCounter(ALL_WORDS, 5, 3, bytes(bits))
    runs = list(counter.add("x", b"a b c d e")) + list(counter.finish())
    assert [p for r in runs for p in C.merge_runs([C._unpack(*r[2:])], 1)] == [(b"a b c", 3, 1)]


def test_text_over_a_slice(spark):
    text = " ".join(f"w{i % 7}" for i in range(500_000)) + " end."
    assert len(text) > C.SLICE
    df = spark.createDataFrame([(1, text, "x", None, 0)], SCHEMA)
    assert mined(df, min_count=100, top=10) == brute([(text, "x")], 100, 10)
