"""Operator 12 against brute force; its plan, odd rows and agreement with labels."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.llm import quality_rules as Q

from .conftest import frame

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(t):
    t = t or ""
    w = WORD.findall(t)
    windows = list(zip(w, w[1:], w[2:]))
    often, cover = Counter(windows), set()
    for i, win in enumerate(windows):
        if often[win] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(cover))


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


def test_measures_equal_brute_force(spark):
    rng = random.Random(5)
    alphabet = ["a", "b", "Éé", "#x", "***", "1", "\n", "\n\n", " ", "\t", "\x0b", "的", "🙂.", "\r\n"]
    texts = ["".join(rng.choice(alphabet) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(80)))
             for _ in range(300)] + [None, "", " \n\t", "a b", "a a a", "a a a a"]
    df = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: base(r) for r in Q.measures(df).collect()}
    assert got == {i: measured(t) for i, t in enumerate(texts)}


def expect(patterns, n_rules, rounds):
    """Plain expectation-maximisation over {digits: n}."""
    kinds, rules = range(n_rules + 1), range(n_rules)
    s0, on_good, on_bad, objects = Q.START
    share0 = [s0] + [(1 - s0) / n_rules] * n_rules
    good0 = [[on_good if k == 0 else objects if j == k - 1 else on_bad for j in rules] for k in kinds]
    share, good = share0, good0

    def posterior(d):
        p = [share[k] * math.prod(good[k][j] if v == 1 else 1 - good[k][j] for j, v in enumerate(d) if v)
             for k in kinds]
        return [x / sum(p) for x in p]

    for _ in range(rounds):
        w = [[0.0, [0.0] * n_rules, [0.0] * n_rules] for _ in kinds]
        for d, n in patterns.items():
            for k, p in enumerate(posterior(d)):
                w[k][0] += n * p
                for j, v in enumerate(d):
                    w[k][1][j] += n * p * (v == 1)
                    w[k][2][j] += n * p * (v > 0)
        total = sum(x[0] for x in w)
        share = [(w[k][0] + Q.SMOOTH * share0[k]) / (total + Q.SMOOTH) for k in kinds]
        rate = [[(w[k][1][j] + Q.SMOOTH * good0[k][j]) / (w[k][2][j] + Q.SMOOTH) for j in rules]
                for k in kinds]
        good = [[min(rate[k][j], rate[0][j], 0.5 if j == k - 1 else 1) for j in rules] for k in kinds]
    return posterior


def test_model_equals_plain_em_and_finds_the_bad(spark):
    rng = random.Random(2)
    patterns = Counter()
    truth = {}
    for _ in range(3000):
        bad = rng.random() < 0.2
        kind = rng.randrange(2)
        d = []
        for j in range(4):
            p_bad = 0.03 if not bad else (0.9 if j // 2 == kind else 0.03)
            d.append(0 if rng.random() < 0.2 else 2 if rng.random() < p_bad else 1)
        patterns[tuple(d)] += 1
        truth.setdefault(tuple(d), Counter())[bad] += 1
    df = spark.createDataFrame([(list(d), n) for d, n in patterns.items()], "digits array<int>, n long")
    model = Q.fit(df, 4)
    want = expect(patterns, 4, Q.ROUNDS)
    got = {tuple(r.digits): r.p for r in df.select("digits", model.posteriors().alias("p")).collect()}
    for d, p in got.items():
        assert abs(p[0] / sum(p) - want(d)[0]) < 1e-6
    right = sum(t[want(d)[0] < 0.5] for d, t in truth.items())
    best = sum(max(t[True], t[False]) for t in truth.values())       # the most that votes can tell
    assert right > 0.95 * best
    assert all(0.5 < a < 1 for a in model.accuracies())


def test_odd_rows_clashes_and_empty(spark, odd_docs, empty_docs):
    rows = Q.classify(odd_docs, rounds=3).collect()
    want = Counter((r.doc_id, *measured(r.text)) for r in odd_docs.collect())
    assert Counter((r.doc_id, *base(r)) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= Q.KEEP_FROM) and 0 <= r.posterior <= 1
    clash = odd_docs
    for c in ("words", "s", "votes", "posterior", "p", "n_words", "lines"):
        clash = clash.withColumn(c, F.lit("x"))
    assert Counter(tuple(r) for r in Q.classify(clash, rounds=3).collect()) == Counter(tuple(r) for r in rows)
    assert Q.classify(empty_docs).count() == 0
    kept = Q.keep_good(clash)
    assert kept.columns == clash.columns and kept.count() <= clash.count()
    assert Q.keep_good(empty_docs).count() == 0


def test_verdict_agrees_with_labels_it_never_saw(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in Q.classify(docs).collect() if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in rows) >= 0.97 * len(rows)
    ids = {r.doc_id for r in Q.keep_good(docs).select("doc_id").collect()}
    assert ids == {r.doc_id for r in Q.classify(docs).filter("kept").collect()}


def test_no_python_and_no_shuffle_of_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = Q.with_votes(Q.measures(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [2, 3])
def test_votes_are_digits(spark, n):
    df = spark.createDataFrame([(100, 500, 0)], "n_words long, word_chars long, n_symbols long")
    assert Q.with_votes(df, Q.RULES[:2]).first().votes == 1 + 3
