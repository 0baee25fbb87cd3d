"""The corpus pipeline, every stage against brute force on its own input."""

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as C
from tierline.llm import mixing, quality
from tierline.llm.common import stored, table
from tierline.llm.queries import tokenizer_path

from .test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def leaks(text, items):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    have = grams(words(text))
    for item in items:
        w = words(item)
        cut = -(-2 * len(w) // 3)
        parts = [grams(w[:max(cut, 5)]), grams(w[min(cut, max(0, len(w) - 5)):])]
        if all(len(p & have) >= 0.8 * len(p) for p in parts):
            return True
    return False


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    (_, classify), (_, dedup), (_, clean), (_, mix), (_, tokens) = C.STAGES

    good = stored(classify(spark, docs, SF), "good")
    scored = quality.classify(docs, table(spark, SF, "labels")).filter("predicted = 1")
    assert good.columns == columns and ids(good) == ids(scored)

    kept = stored(dedup(spark, good, SF), "kept")
    rows = {r.doc_id: slow_fingerprint(r.text) for r in good.collect()}
    small = {}
    for i, f in rows.items():
        small[f] = min(i, small.get(f, i))
    comp = slow_components(small, 4)
    assert kept.columns == columns and ids(kept) == sorted({comp[f] for f in rows.values()})

    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    left = stored(clean(spark, kept, SF), "left")
    assert left.columns == columns
    assert ids(left) == sorted(r.doc_id for r in kept.collect() if not leaks(r.text, items))

    mixed = stored(mix(spark, left, SF), "mixed")
    assert mixed.columns == columns and ids(mixed) == ids(stored(mix(spark, left, SF), "again"))
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(ids(left)) and max(times.values()) <= 3
    size, largest, taken = Counter(), Counter(), Counter()
    for r in left.collect():
        n = len(r.text.split())
        size[r.source] += n
        largest[r.source] = max(largest[r.source], n)
        taken[r.source] += n * times[r.doc_id]
    names = sorted(size)
    targets = mixing.water_fill([size[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))], 3.0)
    assert all(abs(taken[s] - t) <= largest[s] for s, t in zip(names, targets))

    from tokenizers import Tokenizer
    tok, start = Tokenizer.from_file(tokenizer_path()), 0
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens(spark, mixed, SF).collect())
    for r, g in zip(sorted(mixed.collect(), key=lambda r: r.doc_id), got, strict=True):
        want = np.array([*tok.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        assert g == (start, r.doc_id, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_empty_and_odd_documents(spark, odd_docs, empty_docs):
    for docs in (odd_docs, empty_docs):
        for _, stage in C.STAGES:
            docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
