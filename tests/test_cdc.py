import random

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.operators.cdc import (
    END_AT, START_AT, _hot_slices, as_of, scd1, scd1_merge, scd2, split_invalid,
)

SCHEMA = "k string, seq long, payload string"


def rows(df, cols=None):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_late_update_loses(spark):
    df = spark.createDataFrame([("k1", 10, "a"), ("k1", 30, "c"), ("k1", 20, "b")], SCHEMA)
    assert rows(scd1(df, ["k"], "seq")) == [("k1", 30, "c")]


def test_tie_is_order_independent(spark):
    data = [("k", 5, "x"), ("k", 5, "y"), ("k", 5, "z")]
    winners = set()
    for i in range(4):
        random.Random(i).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        winners.add(rows(scd1(df, ["k"], "seq"))[0])
    assert len(winners) == 1


def test_null_key_or_sequence_quarantined(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("k", None, "b"), ("k", 2, "c")], SCHEMA)
    ok, bad = split_invalid(df, ["k"], "seq")
    assert ok.count() == 1 and bad.count() == 2
    assert rows(scd1(df, ["k"], "seq")) == [("k", 2, "c")]


def test_replay_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], SCHEMA)
    snap = scd1(df, ["k"], "seq")
    assert rows(scd1_merge(snap, df, ["k"], "seq")) == rows(snap)


def test_composite_sequence(spark):
    df = spark.createDataFrame([("a", 1, "2"), ("a", 1, "9"), ("a", 0, "z")], SCHEMA)
    assert rows(scd1(df, ["k"], ["seq", "payload"])) == [("a", 1, "9")]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 6), st.sampled_from("xyz")),
                min_size=1, max_size=25),
       st.integers(1, 4), st.randoms())
def test_batching_invariance(spark, data, n_batches, rnd):
    full = scd1(spark.createDataFrame(data, SCHEMA), ["k"], "seq")
    shuffled = list(data)
    rnd.shuffle(shuffled)
    snap = spark.createDataFrame([], SCHEMA)
    for i in range(n_batches):
        part = shuffled[i::n_batches]
        if part:
            snap = scd1_merge(snap, spark.createDataFrame(part, SCHEMA), ["k"], "seq")
    assert rows(snap) == rows(full)


def _brute_scd2(pdf):
    pdf = pdf.drop_duplicates(["k", "seq"]).sort_values(["k", "seq"])
    pdf["end"] = pdf.groupby("k")["seq"].shift(-1)
    return sorted((r.k, int(r.seq), None if pd.isna(r.end) else int(r.end))
                  for r in pdf.itertuples())


def test_scd2_hot_key_split_across_partitions(spark):
    rnd = random.Random(3)
    # key 'hot' holds well over a third of the rows
    data = [("hot", s, "p") for s in rnd.sample(range(10000), 400)]
    data += [(f"k{rnd.randint(0, 30)}", s, "p") for s in rnd.sample(range(10000), 300)]
    df = spark.createDataFrame(data, SCHEMA)
    h = scd2(df, ["k"], "seq", partitions=4, hot_rows=20)
    got = sorted((r.k, r[START_AT], r[END_AT]) for r in h.collect())
    assert got == _brute_scd2(pd.DataFrame(data, columns=["k", "seq", "payload"]))
    bounds = _hot_slices(df, ["k"], "seq", 4, 20).collect()
    assert [r.k for r in bounds] == ["hot"] and len(bounds[0]._bounds) > 20     # really cut


def test_as_of_equals_scd1_of_prefix(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    h = scd2(ev, ["user_id"], "event_id")
    for t in (0, 250, 999):
        a = rows(as_of(h, t))
        b = rows(scd1(ev.filter(F.col("event_id") <= t), ["user_id"], "event_id"))
        assert a == b


def test_scd2_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scd2(df, ["k"], "seq").count() == 0


def test_scd2_without_exchange_reuse(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        h = scd2(ev, ["user_id"], "event_id", partitions=7).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    pdf = ev.select("user_id", "event_id").toPandas().rename(columns={"user_id": "k", "event_id": "seq"})
    assert sorted((r.user_id, r[START_AT], r[END_AT]) for r in h) == _brute_scd2(pdf)


def test_scd2_ties_follow_scd1_rule(spark):
    data = [("k", 1, "a"), ("k", 1, "b"), ("k", 1, "c"), ("k", 2, "x"), ("j", 5, None), ("j", 5, "y")]
    df = spark.createDataFrame(data * 3, SCHEMA).repartition(4)
    h = {(r.k, r.seq): (r.payload, r[END_AT]) for r in scd2(df, ["k"], "seq", partitions=3).collect()}
    winners = {(r.k, r.seq): r.payload for r in scd1(df, ["k", "seq"], "seq").collect()}
    assert {key: v[0] for key, v in h.items()} == winners
    assert h[("k", 1)][1] == 2 and h[("k", 2)][1] is None and h[("j", 5)][1] is None


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]), st.integers(0, 40),
                          st.sampled_from("xyz")), min_size=1, max_size=60),
       st.integers(1, 9))
def test_scd2_matches_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted((r.k, r[START_AT], r[END_AT])
                 for r in scd2(df, ["k"], "seq", partitions=parts, hot_rows=3).collect())
    assert got == _brute_scd2(pd.DataFrame(data, columns=["k", "seq", "payload"]))


def test_map_payload_is_supported(spark):
    df = spark.createDataFrame([("k", 1, {"a": 1}), ("k", 2, {"b": 2})],
                               "k string, seq long, m map<string,int>")
    assert scd1(df, ["k"], "seq").first().m == {"b": 2}
    assert scd2(df, ["k"], "seq").count() == 2


def test_scd2_after_a_shuffle(spark):
    rnd = random.Random(11)
    data = [("hot", s, "p") for s in rnd.sample(range(5000), 300)]
    data += [(f"k{rnd.randint(0, 20)}", s, "p") for s in rnd.sample(range(5000), 200)]
    shuffled = spark.createDataFrame(data, SCHEMA).repartition(7)      # fetch-order rows
    got = sorted((r.k, r[START_AT], r[END_AT])
                 for r in scd2(shuffled, ["k"], "seq", partitions=4, hot_rows=20).collect())
    assert got == _brute_scd2(pd.DataFrame(data, columns=["k", "seq", "payload"]))


def test_scd2_and_as_of_with_timestamp_sequence(spark):
    import datetime as dt
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id")
    h = scd2(ev, ["user_id"], "ts").collect()
    pdf = ev.toPandas().rename(columns={"user_id": "k", "ts": "seq"})
    pdf = pdf.drop_duplicates(["k", "seq"]).sort_values(["k", "seq"])
    pdf["end"] = pdf.groupby("k")["seq"].shift(-1)
    exp = sorted((r.k, r.seq.to_pydatetime(), None if pd.isna(r.end) else r.end.to_pydatetime())
                 for r in pdf.itertuples())
    assert sorted((r.user_id, r[START_AT], r[END_AT]) for r in h) == exp
    at = dt.datetime(2024, 1, 2, 12, 0)
    hist = scd2(ev, ["user_id"], "ts")
    got = rows(as_of(hist, F.lit(at).cast("timestamp_ntz")), ["user_id", "event_id"])
    want = rows(scd1(ev.filter(F.col("ts") <= F.lit(at).cast("timestamp_ntz")), ["user_id"], "ts"),
                ["user_id", "event_id"])
    assert got == want and len(got) > 0


def test_scd2_keeps_payloads_exact(spark):
    """Big nullable integers, the last day of the calendar, NaN keys; also when sliced."""
    rows_ = [(float("nan"), i, 9007199254740993 + i if i % 3 else None, "9999-12-31 23:59:59", "x")
             for i in range(60)] + [(1.5, 1, None, None, None), (1.5, 4, 9007199254740993, None, "y")]
    df = spark.createDataFrame(rows_, "k double, seq long, big long, at string, s string") \
        .withColumn("at", F.col("at").cast("timestamp_ntz"))
    for hot in (10, 10**6):
        got = scd2(df, ["k"], "seq", partitions=1, hot_rows=hot)
        assert got.filter("isnan(k) AND big IS NOT NULL").agg(F.max("big")).first()[0] == 9007199254740993 + 59
        nan = {r.seq: r[END_AT] for r in got.filter("isnan(k)").drop("at").collect()}
        assert nan == {i: i + 1 if i < 59 else None for i in range(60)}
        other = sorted((r.seq, r.big, r[END_AT]) for r in got.filter("k = 1.5").drop("at").collect())
        assert other == [(1, None, 4), (4, 9007199254740993, None)]
        assert got.filter("at = timestamp_ntz'9999-12-31 23:59:59'").count() == 60


def test_merge_takes_new_columns(spark):
    snap = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], SCHEMA)
    ch = spark.createDataFrame([("a", 2, "z", 7)], SCHEMA + ", extra int")
    assert rows(scd1_merge(snap, ch, ["k"], "seq")) == [("a", 2, "z", 7), ("b", 5, "y", None)]


def test_a_repeated_pair_never_meets_in_one_window(spark):
    """Three quarters of all rows repeat one (key, sequence): they collapse in
    a partial aggregate, and the rest is what brute force makes of it."""
    import re
    from pyspark.sql import functions as F
    pair = spark.range(30_000).select(F.lit("a").alias("k"), F.lit(5).cast("long").alias("seq"),
                                      (F.col("id") % 7).cast("string").alias("v"))
    other = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"),
                                       F.col("id").alias("seq"), F.lit("x").alias("v"))
    df = pair.unionByName(other)
    h = scd2(df, ["k"], "seq", partitions=4, hot_rows=100)
    text = h._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Aggregate\(key=\[k#\d+, seq#\d+L\], functions=\[partial_max", text)
    got = {(r.k, r.seq): r[END_AT] for r in h.collect()}
    seqs = {"a": sorted({5, *range(0, 10_000, 2)}), "b": list(range(1, 10_000, 2))}
    want = {(k, s): n for k, held in seqs.items() for s, n in zip(held, [*held[1:], None])}
    assert got == want
