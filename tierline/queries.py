"""Registered queries: one per dataset / operator, each ``(spark, sf_dir) ->
DataFrame`` over the whole given tables. Batch forms here; the streaming
pipelines (which write below the session's checkpoint folder and return a
batch read of what they published) are in ``tierline.streaming.pipelines``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.scalar import owner_slug
from tierline.operators.aggregates import finalize, merge_partials, partials
from tierline.operators.maintenance import dedupe, delete_where
from tierline.plans import fraud, history, ingest, sales, seed, sensors
from tierline.session import work_root
from tierline.sources import testdata as td

FRAUD_PCT = 3.0
BRAND_MIN_AVG = 53000.0
DELETED_ID = "42"
SPLIT_AT = dt.datetime(1998, 1, 1)


# ---- sales (L2) -------------------------------------------------------------
def q_sales_stats(spark: SparkSession, sf: str) -> DataFrame:
    return sales.sales_stats(td.sales_transactions(spark, sf))[0]


def q_sales_stats_expectations(spark: SparkSession, sf: str) -> DataFrame:
    return sales.sales_stats_report(td.sales_transactions(spark, sf))


def q_sales_stats_by_brand_drop(spark: SparkSession, sf: str) -> DataFrame:
    ex = sales.SALES_EXPECTATIONS + [sales.min_avg_value_expectation(BRAND_MIN_AVG)]
    return sales.sales_stats(td.sales_transactions(spark, sf, product="p_brand"), ex)[0]


def q_sales_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    tx = td.sales_transactions(spark, sf)
    return sensors.row_counts({"sales_transactions": tx,
                               "sales_stats": sales.sales_stats(tx)[0]})


def q_sales_stats_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Order price stats per priority kept as mergeable partials: partials
    of the older orders and of the newer ones (as an incremental refresh
    would hold them), folded into the view by the merge."""
    o = td.table(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderdate")
    chunk = F.coalesce(F.col("o_orderdate") < F.lit(SPLIT_AT).cast("timestamp_ntz"),
                       F.lit(False)).alias("_older")
    p = partials(o.select("o_orderpriority", "o_totalprice", chunk),
                 ["o_orderpriority", "_older"], "o_totalprice")
    older = p.filter("_older").drop("_older")
    newer = p.filter(~F.col("_older")).drop("_older")
    return finalize(merge_partials(older, newer, "o_orderpriority"), "o_orderpriority", "price")


# ---- fraud (L3) -------------------------------------------------------------
def _flags(spark, sf):
    return seed.fraud_markers(td.booking_updates(spark, sf), FRAUD_PCT,
                              method="portable", digest="portable")


def _bwf(spark, sf):
    flags = _flags(spark, sf)
    hot = fraud.hot_bookings(flags, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return fraud.bookings_with_fraud(fraud.bookings(td.booking_updates(spark, sf)), flags, hot)


def _gold(spark, sf):
    return fraud.fraud_by_party_and_method(_bwf(spark, sf), td.payments(spark, sf))


def q_bookings_scd1(spark, sf):
    return fraud.bookings(td.booking_updates(spark, sf))


def q_fraud_flags(spark, sf):
    return _flags(spark, sf)


def q_bookings_with_fraud(spark, sf):
    return _bwf(spark, sf)


def q_fraud_by_party_and_method(spark, sf):
    return _gold(spark, sf)


def q_fraud_rate_by_party_size(spark, sf):
    return fraud.fraud_rate_by(_gold(spark, sf), "party_size")


def q_fraud_rate_by_payment_method(spark, sf):
    return fraud.fraud_rate_by(_gold(spark, sf), "payment_method")


def q_fraud_independence_chi2(spark, sf):
    return fraud.fraud_independence(_gold(spark, sf))


def q_fraud_significance(spark, sf):
    """Is fraud related to party size and payment method? Chi-square tests
    with p-values."""
    return fraud.fraud_significance(_gold(spark, sf))


def q_fraud_flags_preview(spark, sf):
    """Preview of the fraud markers: the five lowest booking ids (a top-5)."""
    from tierline.tables import preview
    return preview(_flags(spark, sf), 5, ["booking_id"])


def q_fraud_row_counts(spark, sf):
    """Row counts of the fraud pipeline's datasets, one job."""
    updates, pays = td.booking_updates(spark, sf), td.payments(spark, sf)
    b = fraud.bookings(updates)
    flags = _flags(spark, sf)
    bwf = fraud.bookings_with_fraud(b, flags)
    return sensors.row_counts({
        "booking_updates": updates, "bookings": b, "fraud_flags": flags, "payments": pays,
        "bookings_with_fraud": bwf,
        "fraud_by_party_and_method": fraud.fraud_by_party_and_method(bwf, pays)})


def q_seed_fraud_markers(spark, sf):
    """The seeding job end to end: distinct ids, hash-threshold selection
    (by the hash SQL engines share), murmur3-derived columns, 5 JSON files,
    read back."""
    path = work_root(spark, "seed") + "/booking_fraud_flags"
    return seed.seed_fraud_markers(spark, td.booking_updates(spark, sf), path,
                                   pct=FRAUD_PCT, n_files=5, method="portable")


# ---- continuous medallion (L4), batch form ----------------------------------
def _readings(spark, sf):
    return sensors.readings_bronze(td.readings_feed(spark, sf))


def _registry(spark, sf):
    return sensors.registry_bronze(td.registry_feed(spark, sf))


def q_sensor_readings_bronze(spark, sf):
    return _readings(spark, sf)


def q_sensor_registry_bronze(spark, sf):
    return _registry(spark, sf)


def q_sensor_state_silver(spark, sf):
    return sensors.state_silver(_readings(spark, sf))


def q_sensor_zone_silver(spark, sf):
    return sensors.zone_silver(_registry(spark, sf))


def q_zone_stats_gold(spark, sf):
    return sensors.zone_stats_gold(sensors.state_silver(_readings(spark, sf)),
                                   sensors.zone_silver(_registry(spark, sf)))


def q_zone_stats_gold_sorted(spark, sf):
    return q_zone_stats_gold(spark, sf).orderBy("zone")


def q_medallion_row_counts(spark, sf):
    r, g = _readings(spark, sf), _registry(spark, sf)
    s, z = sensors.state_silver(r), sensors.zone_silver(g)
    return sensors.row_counts({
        "sensor_readings_bronze": r, "sensor_registry_bronze": g,
        "sensor_state_silver": s, "sensor_zone_silver": z,
        "zone_stats_gold": sensors.zone_stats_gold(s, z)})


# ---- history ------------------------------------------------------------------
def q_events_scd2(spark, sf):
    return history.events_history(td.table(spark, sf, "events"))


def q_events_as_of(spark, sf):
    return history.events_as_of(td.table(spark, sf, "events"))


# ---- ingest (L1), batch form --------------------------------------------------
def _measurements(spark, sf):
    """Two producers deliver every record (at-least-once), as JSON text; parse,
    then keep one row per id."""
    lines = ingest.to_json_lines(td.measurement_records(spark, sf))
    delivered = lines.unionByName(lines)
    return dedupe(ingest.parse_json_lines(delivered), ["id"])


def q_measurements(spark, sf):
    return ingest.as_double(_measurements(spark, sf))


def q_measurements_sorted(spark, sf):
    return ingest.as_double(ingest.sorted_view(_measurements(spark, sf)))


def q_measurements_sorted_asc(spark, sf):
    """ORDER BY city, temperature (ascending on both keys)."""
    return ingest.as_double(_measurements(spark, sf).orderBy("city", "temperature"))


def q_measurements_after_delete(spark, sf):
    return ingest.as_double(delete_where(_measurements(spark, sf), ingest.id_is(DELETED_ID)))


def q_owner_slug(spark, sf):
    c = td.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    email = F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("-"),
                     F.col("c_mktsegment"), F.lit("@example.com"))
    return c.select("c_custkey", email.alias("email"), owner_slug(email).alias("owner_slug"))


# ---- some views as Spark SQL over catalog tables ---------------------------------
def q_sales_stats_sql(spark, sf):
    from tierline.plans import sql
    return sql.run(spark, sf, sql.SALES_STATS)


def q_fraud_by_party_and_method_sql(spark, sf):
    from tierline.plans import sql
    return sql.run(spark, sf, sql.FRAUD_BY_PARTY_AND_METHOD)


BATCH_QUERIES = {
    "sales_stats": q_sales_stats,
    "sales_stats_expectations": q_sales_stats_expectations,
    "sales_stats_by_brand_drop": q_sales_stats_by_brand_drop,
    "sales_stats_incremental": q_sales_stats_incremental,
    "sales_row_counts": q_sales_row_counts,
    "bookings_scd1": q_bookings_scd1,
    "fraud_flags": q_fraud_flags,
    "bookings_with_fraud": q_bookings_with_fraud,
    "fraud_by_party_and_method": q_fraud_by_party_and_method,
    "fraud_rate_by_party_size": q_fraud_rate_by_party_size,
    "fraud_rate_by_payment_method": q_fraud_rate_by_payment_method,
    "fraud_independence_chi2": q_fraud_independence_chi2,
    "fraud_significance": q_fraud_significance,
    "fraud_flags_preview": q_fraud_flags_preview,
    "fraud_row_counts": q_fraud_row_counts,
    "seed_fraud_markers": q_seed_fraud_markers,
    "sensor_readings_bronze": q_sensor_readings_bronze,
    "sensor_registry_bronze": q_sensor_registry_bronze,
    "sensor_state_silver": q_sensor_state_silver,
    "sensor_zone_silver": q_sensor_zone_silver,
    "zone_stats_gold": q_zone_stats_gold,
    "zone_stats_gold_sorted": q_zone_stats_gold_sorted,
    "medallion_row_counts": q_medallion_row_counts,
    "events_scd2": q_events_scd2,
    "events_as_of": q_events_as_of,
    "measurements": q_measurements,
    "measurements_sorted": q_measurements_sorted,
    "measurements_sorted_asc": q_measurements_sorted_asc,
    "measurements_after_delete": q_measurements_after_delete,
    "owner_slug": q_owner_slug,
    "sales_stats_sql": q_sales_stats_sql,
    "fraud_by_party_and_method_sql": q_fraud_by_party_and_method_sql,
}
