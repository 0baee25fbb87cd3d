import pytest

from tierline import tables
from tierline.operators.expectations import (
    Expectation, apply_expectations, expectation_report, failed_expectation,
)
from tierline.plans.sales import SALES_EXPECTATIONS, sales_aggregate, sales_stats

SCHEMA = "product string, avg_txn_value double, gross_revenue double"


def test_log_counts_and_keeps_rows(spark):
    df = spark.createDataFrame([("a", 1500.0, 10.0), ("b", 500.0, 10.0)], SCHEMA)
    out, obs = apply_expectations(df, SALES_EXPECTATIONS)
    assert out.count() == 2
    assert obs.get["reasonable_avg_value"] == 1
    assert obs.get["__dropped"] == 0


def test_drop_removes_and_counts(spark):
    df = spark.createDataFrame([("a", 10.0, -5.0), ("b", 10.0, 3.0)], SCHEMA)
    out, obs = apply_expectations(df, SALES_EXPECTATIONS)
    assert [r.product for r in out.collect()] == ["b"]
    assert obs.get["nonneg_revenue"] == 1 and obs.get["__dropped"] == 1


def test_null_predicate_is_a_violation(spark):
    df = spark.createDataFrame([("a", None, None)], SCHEMA)
    out, obs = apply_expectations(df, SALES_EXPECTATIONS)
    assert out.count() == 0
    assert obs.get["reasonable_avg_value"] == 1 and obs.get["nonneg_revenue"] == 1


def test_fail_outranks_drop_and_keeps_old_version(spark, root):
    good = spark.createDataFrame([("a", 10.0, 3.0)], SCHEMA)
    v1 = tables.publish(apply_expectations(good, SALES_EXPECTATIONS)[0], root, "sales_stats")
    bad = spark.createDataFrame([(None, 10.0, -5.0), ("b", 10.0, 1.0)], SCHEMA)
    gated, _ = apply_expectations(bad, SALES_EXPECTATIONS)
    with pytest.raises(Exception) as e:
        tables.publish(gated, root, "sales_stats")
    assert failed_expectation(e.value) == "known_product"
    assert tables.latest_version(spark, root, "sales_stats") == v1
    assert tables.read_latest(spark, root, "sales_stats").collect()[0].product == "a"


def test_report_conservation(spark):
    df = spark.createDataFrame([("a", 1500.0, -1.0), ("b", 10.0, 1.0), ("c", 0.5, 2.0)], SCHEMA)
    rep = {r.expectation: r for r in expectation_report(df, SALES_EXPECTATIONS, "s").collect()}
    for r in rep.values():
        assert r.input_rows == r.output_rows + r.dropped_rows == 3
    assert rep["reasonable_avg_value"].failed_rows == 2
    assert rep["nonneg_revenue"].failed_rows == 1 and rep["nonneg_revenue"].dropped_rows == 1


def test_clean_input_gate_is_identity(spark):
    from tierline.sources.testdata import sales_transactions
    tx = sales_transactions(spark, "/root/testdata/sf0.001")
    plain = sorted(sales_aggregate(tx).collect())
    gated = sorted(sales_stats(tx, [e for e in SALES_EXPECTATIONS if e.action != "log"])[0].collect())
    assert plain == gated and len(plain) == 6


def test_bad_action_and_name():
    with pytest.raises(ValueError):
        Expectation("x", "a > 1", "warn")
    with pytest.raises(ValueError):
        Expectation("bad name", "a > 1")


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], SCHEMA)
    out, obs = apply_expectations(df, SALES_EXPECTATIONS)
    assert out.count() == 0 and out.columns == df.columns
    assert obs.get["__rows"] == 0


def test_gate_in_stream_raises_with_name(spark, root):
    from tierline.streaming.checks import observe_stream
    from tierline.streaming.tables import append_stream
    src = f"{root}/src"
    spark.createDataFrame([(None, 1.0, 1.0)], SCHEMA).write.parquet(src)
    s = spark.readStream.schema(SCHEMA).parquet(src)
    q = append_stream(observe_stream(s, SALES_EXPECTATIONS, "chk"), root, "t")
    with pytest.raises(Exception) as e:
        q.awaitTermination()
    assert failed_expectation(e.value) == "known_product"


def test_no_expectations_still_counts_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0)], SCHEMA)
    out, obs = apply_expectations(df, [])
    assert out.count() == 1 and obs.get["__rows"] == 1 and obs.get["__dropped"] == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_vals = st.one_of(st.none(), st.floats(-100, 2000, allow_nan=False))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), _vals, _vals), max_size=20))
def test_conservation_property(spark, rows_):
    exps = [e for e in SALES_EXPECTATIONS if e.action != "fail"]
    df = spark.createDataFrame(rows_, SCHEMA)
    rep = {r.expectation: r for r in expectation_report(df, exps, "s").collect()}
    out, obs = apply_expectations(df, exps)
    written = out.count()
    for r in rep.values():
        assert r.input_rows == len(rows_) == written + r.dropped_rows
    brute_drop = sum(1 for _, _, rev in rows_ if rev is None or rev < 0)
    brute_log = sum(1 for _, avg, _ in rows_ if avg is None or not (1 <= avg <= 1000))
    assert rep["nonneg_revenue"].failed_rows == brute_drop == rep["nonneg_revenue"].dropped_rows
    assert rep["reasonable_avg_value"].failed_rows == brute_log == obs.get["reasonable_avg_value"]
