"""Sizes that switch nothing: many sources, long texts in pieces, repeated ids."""

import numpy as np
from pyspark.sql import functions as F

from tierline.llm import mixing, quality
from tierline.llm.common import labelled_sample


def test_source_targets_equal_the_list_form(spark):
    rng = np.random.default_rng(5)
    for sizes in ([10, 1000, 5], [0, 0], [7], (rng.pareto(0.4, 3000) * 10).astype(int).tolist(),
                  [10 ** k for k in range(12)]):
        names = [f"s{i:05d}" for i in range(len(sizes) - 1)] + [None]
        sized = spark.createDataFrame(list(zip(names, sizes, strict=True)) + [(names[0], None)],
                                      "source string, size long").repartition(5)
        got = sorted(mixing.source_targets(sized).collect(), key=lambda r: r.source_no)
        assert [r.source for r in got] == names and [r.source_no for r in got] == list(range(len(names)))
        want = mixing.water_fill([float(x) for x in sizes],
                                 [mixing.WEIGHTS[i % 3] for i in range(len(sizes))], 3.0)
        assert np.allclose([r.target for r in got], want, rtol=1e-9)
        assert sum(r["rows"] for r in got) == len(sizes) + 1


def test_mix_of_many_sources_and_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    monkeypatch.setattr(mixing, "LARGE", 3)          # the hot source is salted
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 400)).alias("source"))
    got = mixing.mixture(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(got) == 3000
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 6 + 1e-6      # one document
        assert all(0 <= r.copies <= 3 for r in mine)


def test_features_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    words = ["ab", "the", "x" * 40, "é中", "go"]
    texts = ["".join(words[k] + [" ", "\n", "   "][k % 3] for k in np.repeat(rng.integers(0, 5, 60), 3)),
             "y" * 500, " " * 300 + "a a a a a" + " " * 300 + "a a a b", "one " * 100, ""]
    whole = [quality.features(t) for t in texts]
    for piece in (3, 16, 64, 200):
        monkeypatch.setattr(quality, "PIECE", piece)
        for t, f in zip(texts, whole, strict=True):
            assert np.array_equal(quality.features(t), f)


def test_sample_has_a_row_per_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (3, "d")] + [(2, "c")] * 50,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 0), (3, 1)], "doc_id long, quality int")
    rows, have = labelled_sample(docs, labels, "quality", 5, 9, {0: 10, 1: 10}, "doc_id", "text")
    assert sorted((r.text, r.y) for r in rows.collect()) == [("", 1), ("c", 0), ("d", 1)]
    assert have == {0: 1, 1: 2}
