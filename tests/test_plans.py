"""Plan properties the design relies on at scale (checked on final plans)."""

import re

from tierline.operators.cdc import scd1, scd2
from tierline.plans import fraud, seed
from tierline.sources import testdata as td

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_scd1_reduces_before_the_shuffle(spark):
    p = final_plan(scd1(td.booking_updates(spark, SF), ["booking_id"], td.BOOKING_SEQUENCE))
    lines = p.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(booking_id" in l)
    assert any("partial_max(" in l for l in lines[ex + 1:])       # below the exchange


def test_scans_read_only_needed_columns(spark):
    p = final_plan(td.sales_transactions(spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = next(s for s in schemas if "l_orderkey" in s)
    assert set(x.split(":")[0] for x in lineitem.split(",")) == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"}


def test_sample_threshold_reaches_the_scan(spark):
    m = seed.fraud_markers(td.booking_updates(spark, SF), 3.0, method="portable", digest="portable")
    p = final_plan(m)
    scan = next(l for l in p.splitlines() if "FileScan parquet" in l)
    assert "pmod" in scan                       # DataFilters: the threshold, below the distinct


def test_gold_joins_pre_aggregated_sides(spark):
    ups = td.booking_updates(spark, SF)
    flags = seed.fraud_markers(ups, 3.0, method="portable", digest="portable")
    gold = fraud.fraud_by_party_and_method(
        fraud.bookings_with_fraud(fraud.bookings(ups), flags), td.payments(spark, SF))
    p = final_plan(gold)
    assert "partial_count" in p
    join = next(i for i, l in enumerate(p.splitlines()) if "Join" in l and "LeftOuter" not in l)
    below = "\n".join(p.splitlines()[join:])
    assert below.count("count(1)") >= 2         # both join inputs are per-booking counts


def test_scd2_shuffles_the_rows_once_in_the_jvm(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = final_plan(scd2(ev, ["user_id"], "event_id"))
    assert "MapInPandas" not in p and "ArrowEval" not in p
    lines = p.splitlines()
    wide = [l for l in lines if "Exchange hashpartitioning(user_id" in l and "_slice" in l]
    assert len(wide) >= 1
    assert sum("Window" in l for l in lines) >= 1
