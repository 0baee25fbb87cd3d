"""Operator 13 against a plain tree, with blocks of every size; odd rows."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.llm import manifest as M

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> Counter of results"""
    def leaf(r, text):
        return h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        held = sorted(trees[s], key=lambda t: t[:3])
        trees[s] = (held, levels_of([t[2] for t in held]))
    top = levels_of([trees[s][1][-1][0] for s in sources])
    out = Counter()
    for k, s in enumerate(sources):
        held, levels = trees[s]
        for i, (_, _, lf, r) in enumerate(held):
            now, proof = lf, []
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0:
                now = leaf(r, None if r[1] is None else r[1].replace("\n", ""))
            for tree, at in ((levels, i), (top, k)):
                for level in tree[:-1]:
                    a = at - at % 3
                    left, right = level[a:at], level[at + 1:a + 3]
                    proof += left + right
                    now = h(*left, now, *right)
                    at //= 3
            root = top[-1][0]
            out[r[0], lf, levels[-1][0], root, h(*proof), now, now == root] += 1
    return out


def results(df, **kw):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in M.manifest(df, **kw).collect())


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_equals_a_plain_tree(spark, levels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain(rows_of(docs))
    assert results(docs, levels=levels) == want
    assert {k[-1] for k in want} == {True, False}


def test_odd_rows_clashes_and_empty(spark, odd_docs, empty_docs):
    want = plain(rows_of(odd_docs))
    assert results(odd_docs, levels=2) == want
    clash = odd_docs
    for c in ("tree", "pos", "leaf", "n", "path", "root", "block", "changed"):
        clash = clash.withColumn(c, F.lit("x"))
    assert results(clash, levels=2) == want
    assert M.manifest(empty_docs).count() == 0 and M.copied_nodes(empty_docs).count() == 0


def test_one_row_and_many_sources(spark, odd_docs):
    schema = odd_docs.schema
    one = spark.createDataFrame([(5, "a\nb", "en", "s", 3)], schema)
    assert results(one) == plain(rows_of(one))
    many = spark.createDataFrame([(i, f"t\n{i}", "en", ["s", ":", "é:1", "10", "9"][i % 5] + str(i // 15), i)
                                  for i in range(300)], schema)
    assert results(many, levels=1) == plain(rows_of(many))


def test_many_equal_rows(spark, odd_docs):
    same = spark.createDataFrame([(7, "x\ny", "en", "hot", 3)] * 2000, odd_docs.schema)
    assert results(same, levels=3) == plain(rows_of(same))


def test_versions_share_all_but_their_ancestors(spark):
    leaves = [h(str(i)) for i in range(20)]
    block = M.Block(leaves, M.height(20))
    before = [list(level) for level in block.nodes]
    for at in (0, 7, 18, 19):
        v = M.Version(block, at, h("new"))
        changed = leaves[:at] + [h("new")] + leaves[at + 1:]
        whole = levels_of(changed)
        assert [len(v.copied)] == [len(whole)] and v.root == whole[-1][0]
        assert all(v.node(k, i) == d for k, level in enumerate(whole) for i, d in enumerate(level))
    assert block.nodes == before                    # the original is untouched


@pytest.mark.parametrize("levels", [1, 8])
def test_copied_nodes(spark, levels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = M.copied_nodes(docs, levels=levels).collect()
    folded = {r.doc_id: r.folded_root for r in M.manifest(docs, levels=levels).collect()}
    leaf = {r.doc_id: r.leaf for r in M.manifest(docs, levels=levels).collect()}
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, {})[r.level] = r
    chosen = {d for d in leaf if zlib.crc32(str(d).encode()) % 2 == 0}
    assert set(by_doc) == chosen
    for d, nodes in by_doc.items():
        assert sorted(nodes) == list(range(len(nodes)))
        assert nodes[len(nodes) - 1].digest == folded[d]


def test_positions_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert results(docs.repartition(13)) == results(docs.orderBy(F.desc("text")).coalesce(2))
