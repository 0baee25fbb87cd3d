"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tierline.llm import simhash
from tierline.llm.queries import q_op7_simhash


def slow_fingerprint(text, k=4):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, radius):
    """fps: {fp: smallest id}; {fp: smallest id reachable} by comparing all pairs."""
    todo, out = set(fps), {}
    while todo:
        group, front = set(), [todo.pop()]
        while front:
            x = front.pop()
            group.add(x)
            near = {y for y in todo if (x ^ y).bit_count() <= radius}
            todo -= near
            front += near
        ids = [fps[x] for x in group if fps[x] is not None]
        out |= dict.fromkeys(group, min(ids) if ids else None)
    return out


def check(rows, got, radius=4):
    want_fp = [(i, slow_fingerprint(t)) for i, t in rows]
    small = {}
    for i, f in want_fp:
        old = small.get(f)
        small[f] = i if old is None else old if i is None else min(i, old)
    comp = slow_components(small, radius)
    want = sorted(((i, f"{f:016x}", comp[f]) for i, f in want_fp), key=str)
    assert sorted(got, key=str) == want


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()],
          [tuple(r) for r in q_op7_simhash(spark, sf).collect()])


def test_odd_rows(spark, odd_docs, empty_docs):
    out = simhash.near_duplicates(odd_docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    check([(r.doc_id, r.text) for r in odd_docs.collect()], [tuple(r) for r in out.collect()])
    assert simhash.near_duplicates(empty_docs).count() == 0
    clash = odd_docs.withColumn("fp", F.lit("x")).withColumn("row", F.lit(1))
    kept = simhash.dedup(clash)
    assert kept.columns == clash.columns
    comps = {r.component_id for r in out.collect()}
    assert kept.count() == len(comps)


def test_links_of_dense_shards_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 16)        # also cuts shards into parts
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = {x - (1 << 64) if x >> 63 else x for x in fps}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = slow_components({x: x for x in fps}, 4)
    for n in (len(fps), 10**6, 10**9):              # 5, 6 and 7 blocks
        comp = {r.node: r.root for r in simhash.connected(simhash.links(df, 4, n)).collect()}
        got = {}
        for x in fps:
            s = x - (1 << 64) if x >> 63 else x
            got.setdefault(comp.get(s, s), set()).add(x)
        groups = {}
        for x, c in want.items():
            groups.setdefault(c, set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_forest_follows_edges_within_radius():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 12, 500, dtype=np.uint64)
    group = np.sort(rng.integers(0, 7, 500))
    forest = simhash.BKForest(fps, group, 7)
    got = {(int(a), int(b)) for q, m in forest.within(fps, group, 3) for a, b in zip(q, m)}
    want = {(i, j) for i in range(500) for j in range(500)
            if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want


def test_component_of_null_ids_keeps_one_row(spark):
    rng = random.Random(11)
    words = [f"w{rng.getrandbits(40)}" for _ in range(2000)]
    texts = [" ".join([*words[:i * 300], "changed", *words[i * 300 + 1:]]) for i in range(1, 7)]
    rows = [(None, t) for t in texts] + [(None, " ".join(rng.sample(words, 40))), (7, "one text"),
                                         (7, " ".join(rng.sample(words, 50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [int(r.fingerprint, 16) for r in simhash.near_duplicates(docs.limit(6)).collect()]
    near = {p for p in prints if any(0 < (p ^ q).bit_count() <= simhash.RADIUS for q in prints)}
    assert len(near) > 1
    parts = [{p} for p in set(prints)]
    for p in set(prints):
        for q in set(prints):
            if (p ^ q).bit_count() <= simhash.RADIUS:
                joined = set().union(*(x for x in parts if p in x or q in x))
                parts = [x for x in parts if not x & joined] + [joined]
    assert len(parts) < len(set(prints))
    kept = simhash.dedup(docs)
    assert kept.filter(F.col("text").contains("changed")).count() == len(parts)
    assert kept.count() == len(parts) + 3
