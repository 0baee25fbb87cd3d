from pyspark.sql import functions as F

from tierline import tables
from tierline.session import work_root

SCHEMA = "k long, v string"


def test_work_root_is_below_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    r1, r2 = work_root(spark, "x"), work_root(spark, "x")
    assert r1.startswith(base.rstrip("/")) and r1 != r2


def test_publish_versions_and_latest(spark, root):
    assert tables.latest_version(spark, root, "d") is None
    assert tables.read_latest(spark, root, "d") is None
    assert tables.read_latest(spark, root, "d", SCHEMA).count() == 0
    v1 = tables.publish(spark.createDataFrame([(1, "a")], SCHEMA), root, "d")
    v2 = tables.publish(spark.createDataFrame([(2, "b"), (3, "c")], SCHEMA), root, "d")
    assert (v1, v2) == (1, 2)
    assert tables.read_latest(spark, root, "d").count() == 2
    assert tables.read_version(spark, root, "d", 1).first().v == "a"


def test_uncommitted_version_is_ignored(spark, root):
    tables.publish(spark.createDataFrame([(1, "a")], SCHEMA), root, "d")
    # a version folder without _SUCCESS (a writer that died) does not count
    spark.createDataFrame([(9, "z")], SCHEMA).write.parquet(tables.version_path(root, "d", 2) + "/part")
    assert tables.latest_version(spark, root, "d") == 1
    assert tables.publish(spark.createDataFrame([(5, "e")], SCHEMA), root, "d") == 3


def test_bucketed_copy_join_does_not_shuffle_it(spark, root):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
        b = tables.bucketed_copy(dim, root, "dim", ["k"], buckets=8)
        again = tables.bucketed_copy(dim, root, "dim", ["k"], buckets=8)   # reused, not rewritten
        facts = spark.range(5000).select((F.col("id") % 1000).alias("k"))
        j = facts.join(b, "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1       # the fact side only
        assert j.count() == 5000 and again.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_preview_is_ordered_top_n(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert [r.k for r in tables.preview(df, 3, ["k"]).collect()] == [0, 1, 2]


def test_retain_keeps_newest_versions(spark, root):
    for i in range(4):
        tables.publish(spark.createDataFrame([(i, "x")], SCHEMA), root, "d")
    spark.createDataFrame([(9, "z")], SCHEMA).write.parquet(tables.version_path(root, "d", 2) + "x")
    assert tables.retain(spark, root, "d", keep=2) == [1, 2]
    assert tables.latest_version(spark, root, "d") == 4
    assert tables.read_version(spark, root, "d", 3).first().k == 2
    assert not tables.exists(spark, tables.version_path(root, "d", 1))


def test_flow_retain_keeps_quarantine_and_current(spark, root):
    from tierline.streaming.tables import append_stream, data_path, stream_files
    from tierline.streaming.upsert import Scd1Flow
    sch = "k string, seq long, payload string"
    land = root + "/land"
    flow = Scd1Flow(root, "silver", ["k"], "seq")
    for batch in ([("a", 1, "x"), (None, 1, "bad")], [("a", 2, "y")], [("b", 1, "z")]):
        spark.createDataFrame(batch, sch).write.mode("append").parquet(land)
        append_stream(stream_files(spark, land, sch), root, "bronze").awaitTermination()
        flow.run(spark, data_path(spark, root, "bronze"))
    assert flow.retain(spark, keep=1) == [1, 2]
    assert flow.current_version(spark) == 3
    assert sorted(tuple(r) for r in flow.read(spark).collect()) == [("a", 2, "y"), ("b", 1, "z")]
    assert flow.quarantine(spark).count() == 1
    spark.createDataFrame([("c", 5, "w")], sch).write.mode("append").parquet(land)
    append_stream(stream_files(spark, land, sch), root, "bronze").awaitTermination()
    assert flow.run(spark, data_path(spark, root, "bronze")) == 4
    assert flow.read(spark).count() == 3


def test_registered_table_comment(spark, root):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    tables.publish_table(df, root, "kpis", comment="Sales KPIs per product")
    try:
        assert spark.catalog.getTable("kpis").description == "Sales KPIs per product"
    finally:
        spark.sql("DROP TABLE kpis")


def test_publish_bucketed_empty_and_full(spark, root):
    empty = spark.createDataFrame([], SCHEMA)
    tables.publish_bucketed(empty, root, "b", ["k"], 4)
    got = tables.read_latest_bucketed(spark, root, "b", ["k"], 4)
    assert got.count() == 0 and got.columns == ["k", "v"]
    tables.publish_bucketed(spark.range(50).selectExpr("id AS k", "'x' AS v"), root, "b", ["k"], 4)
    full = tables.read_latest_bucketed(spark, root, "b", ["k"], 4)
    assert full.count() == 50
    assert "Bucketed: true" in full.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
