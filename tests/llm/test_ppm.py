"""Prediction by partial matching against a plain trie walked byte by byte."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import zstandard

from tierline.llm import ppm
from tierline.llm.queries import q_op8_lm_score


def slow_scores(rows, order=ppm.ORDER, folds=5, held_fold=1):
    def norm(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", t)
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % folds == held_fold for i, _ in rows]
    docs = [norm(t) for _, t in rows]
    trie, words = defaultdict(Counter), Counter()
    for w, h in zip(docs, held):
        if not h:
            words.update([*w, "\n"])
            seq = b"\n" * order + " ".join(w).encode() + b"\n"
            for i in range(order, len(seq)):
                for k in range(order + 1):
                    trie[seq[i - k:i]][seq[i]] += 1
    n, v = sum(words.values()), len(words)
    for (i, _), w, h in zip(rows, docs, held):
        seq, score = b"\n" * order + " ".join(w).encode() + b"\n", 0.0
        for p in range(order, len(seq)):
            refused, s = set(), seq[p]
            for k in range(order, -1, -1):
                seen = {x: c for x, c in trie.get(seq[p - k:p], {}).items() if x not in refused}
                if s in seen:
                    score += math.log10((2 * seen[s] - 1) / (2 * sum(seen.values())))
                    break
                if seen:
                    score += math.log10(len(seen) / (2 * sum(seen.values())))
                    refused |= set(seen)
            else:
                score -= math.log10(256 - len(refused))
        toks = [*w, "\n"]
        base = sum(math.log10((words[t] + 0.5) / (n + 0.5 * (v + 1))) for t in toks)
        yield i, h, len(toks), sum(words[t] > 0 for t in toks), n, base, score


def same(got, rows):
    got = sorted((tuple(r) for r in got), key=str)
    want = sorted(slow_scores(rows), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_equals_plain_trie(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q_op8_lm_score(spark, sf).collect()
    same(got, rows)
    held = [r for r in got if r.held_out]
    assert held and all(r.score < 0 for r in held)


def test_odd_rows_in_small_blocks(spark, odd_docs, empty_docs, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 200)
    monkeypatch.setattr(ppm, "PIECE", 64)
    small = odd_docs.filter("doc_id is null or doc_id not in (9, 10)")
    same(ppm.score_texts(small).collect(), [(r.doc_id, r.text) for r in small.collect()])
    assert ppm.score_texts(empty_docs).count() == 0


TEXTS = [b"", b"a", b"ab", b"", b"abcdefgh", b"the cat", b"x", b"", b"the cat sat on the mat", b"abcdef"]


def block(texts):
    return b"".join(t + b"\n" for t in texts), np.array([len(t) for t in texts])


@pytest.mark.parametrize("piece", [1, 3, 7, 64])
def test_ngrams_and_documents_at_any_cut(piece):
    """Short texts, whose first bytes are seen from the pieces behind them."""
    s = ppm.Stream(*block(TEXTS))
    docs = [i for i, t in enumerate(TEXTS) for _ in range(len(t) + 1)]
    keys = [int.from_bytes((b"\n" * ppm.ORDER + t + b"\n")[i:i + ppm.ORDER + 1])
            for t in TEXTS for i in range(len(t) + 1)]
    cuts = [(at, min(at + piece, len(s.a))) for at in range(0, len(s.a), piece)]
    assert [k for c in cuts for k in s.ngrams(*c).tolist()] == keys
    assert [d for c in cuts for d in s.docs(*c).tolist()] == docs


def test_block_is_counted_and_scored_without_indirect_sort(monkeypatch):
    """Neither counting nor looking up sorts the positions of a text by index, which took
    most of the CPU time; counts and scores are those of plain dictionaries."""
    def refuse(a, **kw):
        raise AssertionError(f"np.unique of {len(a)} positions")
    monkeypatch.setattr(np, "unique", refuse)
    monkeypatch.setattr(ppm, "PIECE", 16)       # over eight pieces: parts are merged on the way
    texts = TEXTS * 4
    text, lens = block(texts)
    held = np.arange(len(texts)) % 3 == 0
    s = ppm.Stream(text, lens)
    grams = s.ngrams(0, len(text)).tolist()
    of = s.docs(0, len(text))
    want = Counter(k for k, d in zip(grams, of) if not held[d])
    answers, logp = [], {}
    for kind, keys, counts in ppm.vocabulary(s, held):
        assert (np.diff(keys.astype(object)) > 0).all() and counts.dtype == np.int64
        if kind == ppm.NGRAM:
            assert dict(zip(keys.tolist(), counts.tolist())) == {k: want[k] for k in grams}
            values = -1.0 - np.arange(len(keys)) % 7
            logp = dict(zip(keys.tolist(), values))
        else:
            values = counts.astype(float)
        answers += [(kind, ppm.pack_keys(keys[i::3]), ppm.pack(values[i::3])) for i in range(3)]
    rows = pd.DataFrame({"block": [0], "ids": [[str(i) for i in range(len(texts))]], "held": [held],
                         "lens": [lens], "text": [text]})
    got = ppm._score(rows, pd.DataFrame(answers, columns=["kind", "keys", "values"]), 50, 9)
    scores = [sum(logp[k] for k, d in zip(grams, of) if d == i) for i in range(len(texts))]
    assert got["score"].tolist() == scores
    words = Counter(w for t, h in zip(texts, held) if not h for w in [*t.split(), b"\n"])
    assert got["n_known"].tolist() == [sum(words[w] > 0 for w in [*t.split(), b"\n"]) for t in texts]
    base = [sum(math.log10((words[w] + 0.5) / (50 + 0.5 * 10)) for w in [*t.split(), b"\n"]) for t in texts]
    assert got["base_score"].tolist() == pytest.approx(base)


@pytest.mark.parametrize("crowd", [1, 40, 400])
def test_parted_contexts_equal_plain_trie(spark, odd_docs, monkeypatch, crowd):
    """Contexts asked more often than ``CROWD`` lie in several shards, at the least all
    of them down to single contexts of ORDER bytes; the scores stay those of one trie."""
    monkeypatch.setattr(ppm, "CROWD", crowd)
    monkeypatch.setattr(ppm, "ANSWERS", 3)
    docs = odd_docs.filter("doc_id is null or doc_id not in (9, 10)").repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [(200 + i, f"the cat {i % 7} sat on the mat, the hat {'th' * (i % 5)} that\x00{i}") for i in range(60)]
    more = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    same(ppm.score_texts(docs.select("doc_id", "text").union(more)).collect(), rows + texts)


def test_blocks_are_stored_compressed(spark):
    """A block's text goes through the JVM compressed: as plain rows of 16 MB it filled
    an executor's heap."""
    texts = [f"The Cat  sat on\tthe mat {i}" for i in range(3000)]
    docs = spark.createDataFrame([(str(i), False, t) for i, t in enumerate(texts)],
                                 "id string, held boolean, text string").coalesce(1)
    (r,) = docs.mapInArrow(ppm._blocks, ppm.BLOCKS).collect()
    plain = b"".join(ppm.normalised(t) + b"\n" for t in texts)
    assert len(r.text) < len(plain) / 2 and zstandard.decompress(bytes(r.text)) == plain
    assert r.lens == [len(ppm.normalised(t)) for t in texts]


def test_crowded_context_is_dealt_over_shards(spark, monkeypatch):
    """No shard is asked for all n-grams behind a common two-byte context; before, its
    shard had a fixed share of the corpus."""
    rng = np.random.default_rng(5)
    words = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) + "th" for _ in range(60)) for _ in range(20)]
    s = ppm.Stream(*block([w.encode() for w in words]))
    keys = next(ppm.vocabulary(s, np.zeros(len(words), bool)))[1]
    hot = keys[(keys >> np.uint64(8)) & np.uint64(0xFFFF) == int.from_bytes(b"h ")]
    assert len(hot) > 100
    contexts, n = ppm.crowded(keys, 25)
    order = contexts >> np.uint64(8 * ppm.ORDER)
    parted = [ppm.suffix(contexts[order == k], ppm.ORDER) for k in range(2, ppm.ORDER)]
    for k, known in enumerate(parted, 2):
        have = Counter(ppm.suffix(keys >> np.uint64(8), k).tolist())
        assert {c: m for c, m in have.items() if m > 25} == dict(zip(known.tolist(), n[order == k].tolist()))
    shards = 1 << 16
    most = max(Counter(ppm.shard_of(ppm.NGRAM, keys, shards, parted).tolist()).values())
    assert most < max(Counter(ppm.shard_of(ppm.NGRAM, keys, shards).tolist()).values()) / 2
    for k, known in enumerate(parted, 2):               # a context that is not parted is in one shard
        ctx = ppm.suffix(keys >> np.uint64(8), k)
        whole = ~ppm.among(known, ctx)
        where = defaultdict(set)
        for c, shard in zip(ctx[whole].tolist(), ppm.shard_of(ppm.NGRAM, keys, shards, parted)[whole].tolist()):
            where[c].add(shard)
        assert all(len(x) == 1 for x in where.values())
