"""The streaming pipelines as registered queries: each runs a pipeline below a
fresh folder and reads what it published. The inputs arrive in deliveries made
here from the given tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierline import tables
from tierline.plans import ingest, sensors
from tierline.session import work_root
from tierline.sources import testdata as td
from tierline.streaming.pipelines import (
    Medallion, _sales_dimensions, delete_from, fraud_pipeline, ingest_landing, measurements_pipeline,
    medallion_feeds, sales_pipeline,
)
from tierline.streaming.tables import (
    append_stream, data_path, name_table, read_table, stream_by_name, stream_files,
)
from tierline.streaming.upsert import Scd1Flow, Scd2Flow


# ---- deliveries ------------------------------------------------------------------
def sales_round(spark: SparkSession, sf_dir: str, root: str, full_refresh: bool = False) -> None:
    """The landed line items into bronze, then into the incremental view."""
    from tierline.streaming.incremental import IncrementalSalesStats
    schema = td.table(spark, sf_dir, "lineitem").schema
    orders, part = _sales_dimensions(spark, sf_dir, root)
    landed = stream_files(spark, f"{root.rstrip('/')}/landing/lineitem", schema)
    tx = td.sales_transactions(spark, sf_dir, lineitem=landed, orders=orders, part=part, waiting=True)
    append_stream(tx, root, "sales_transactions", full_refresh=full_refresh).awaitTermination()
    late = td.late_transactions(spark, sf_dir, read_table(spark, root, "sales_transactions"))
    IncrementalSalesStats(root).refresh(spark, data_path(spark, root, "sales_transactions"), late)


def sales_in_rounds(spark: SparkSession, sf_dir: str, root: str, rounds: int = 3) -> None:
    """The line items delivered in ``rounds`` deliveries (a hash split of all
    rows), each followed by ``sales_round``."""
    li = td.table(spark, sf_dir, "lineitem")
    part_of = F.pmod(F.xxhash64(*[F.col(c) for c in li.columns]), F.lit(rounds))
    for r in range(rounds):
        li.filter(part_of == r).write.mode("append").parquet(f"{root.rstrip('/')}/landing/lineitem")
        sales_round(spark, sf_dir, root)


def bookings_in_rounds(spark: SparkSession, sf_dir: str, root: str, rounds: int = 3) -> Scd1Flow:
    """The CDC feed delivered in ``rounds`` deliveries (a hash split of all
    rows, so sequences arrive out of order), each landed, streamed into
    bronze and merged before the next arrives."""
    feed = td.booking_updates(spark, sf_dir)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in feed.columns]), F.lit(rounds))
    landing = f"{root.rstrip('/')}/landing/booking_updates"
    flow = Scd1Flow(root, "bookings", ["booking_id"], td.BOOKING_SEQUENCE)
    for r in range(rounds):
        feed.filter(part == r).write.mode("append").parquet(landing)
        append_stream(stream_files(spark, landing, feed.schema), root, "booking_updates").awaitTermination()
        flow.run(spark, data_path(spark, root, "booking_updates"))
    return flow


def history_in_rounds(spark: SparkSession, sf_dir: str, root: str, rounds: int = 3) -> Scd2Flow:
    """The events feed delivered in ``rounds`` deliveries (hash split, so
    sequences arrive out of order); after each one the history of the touched
    users is re-chained (STORED AS SCD TYPE 2)."""
    ev = td.table(spark, sf_dir, "events")
    part_of = F.pmod(F.xxhash64(*[F.col(c) for c in ev.columns]), F.lit(rounds))
    landing = f"{root.rstrip('/')}/landing/events"
    flow = Scd2Flow(root, "events_history", ["user_id"], "event_id")
    for r in range(rounds):
        ev.filter(part_of == r).write.mode("append").parquet(landing)
        append_stream(stream_files(spark, landing, ev.schema), root, "events_bronze").awaitTermination()
        flow.run(spark, data_path(spark, root, "events_bronze"))
    return flow


# ---- registered queries -------------------------------------------------------
_RUNS: dict = {}


def _state(spark: SparkSession, path: str) -> str:
    """A digest of the files below ``path`` (names, sizes, times)."""
    fs, p, _ = tables.filesystem(spark, path)
    state, todo = hashlib.sha1(), [p]
    while todo:
        for st in sorted(fs.listStatus(todo.pop()), key=lambda s: s.getPath().toString()):
            if st.isDirectory():
                todo.append(st.getPath())
            state.update(f"{st.getPath().toString()} {st.getLen()} {st.getModificationTime()}\n".encode())
    return state.hexdigest()


def _run_once(spark: SparkSession, sf_dir: str, name: str, fn) -> str:
    """Runs a pipeline once per application, pipeline and state of the input
    files; the published datasets of that run serve every query that reads
    them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir), name)
    if key not in _RUNS:
        root = work_root(spark, name)
        fn(root)
        _RUNS[key] = root
    return _RUNS[key]


def _sales_root(spark, sf):
    return _run_once(spark, sf, "sales", lambda r: sales_pipeline(spark, sf, r))


def _fraud_root(spark, sf):
    return _run_once(spark, sf, "fraud", lambda r: fraud_pipeline(spark, sf, r))


def _medallion_root(spark, sf):
    def go(r):
        m = Medallion(spark, r).start(*medallion_feeds(spark, sf))
        m.run_triggered()
        tables.publish(m.expectation_report(), r, "sensor_readings_expectations")
    return _run_once(spark, sf, "medallion", go)


def _measurements_root(spark, sf):
    def go(r):
        measurements_pipeline(spark, sf, r)
        delete_from(spark, r, "measurements", ingest.id_is("42"), ingest.MEASUREMENTS_SCHEMA)
    return _run_once(spark, sf, "measurements", go)


def q_sales_pipeline_rerun(spark, sf):
    """Two triggered updates, the second without new input, and a full refresh."""
    def go(r):
        sales_pipeline(spark, sf, r)
        sales_pipeline(spark, sf, r)
        sales_pipeline(spark, sf, r, full_refresh=True)
    return tables.read_latest(spark, _run_once(spark, sf, "sales_rerun", go), "sales_stats")


def q_sales_incremental_after_full_refresh(spark, sf):
    """Incremental states after their source table was loaded anew."""
    def go(r):
        sales_in_rounds(spark, sf, r, rounds=2)
        sales_round(spark, sf, r, full_refresh=True)
    return tables.read_latest(spark, _run_once(spark, sf, "sales_reloaded", go), "sales_stats")


def q_fraud_pipeline_rerun(spark, sf):
    """Two triggered updates on one root: no flag is delivered twice."""
    def go(r):
        fraud_pipeline(spark, sf, r)
        fraud_pipeline(spark, sf, r)
    return tables.read_latest(spark, _run_once(spark, sf, "fraud_rerun", go),
                              "fraud_by_party_and_method")


def q_measurements_delete_then_ingest(spark, sf):
    """Records that come after a delete are in the table after the next one."""
    def go(r):
        recs = td.measurement_records(spark, sf)
        first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
        for part in (first, ~first):
            ingest.land(recs.filter(part), r + "/landing/measurements")
            ingest_landing(spark, r + "/landing/measurements", r)
            delete_from(spark, r, "measurements", ingest.id_is("42"), ingest.MEASUREMENTS_SCHEMA)
    root = _run_once(spark, sf, "measurements_split", go)
    return ingest.as_double(tables.read_latest(spark, root, "measurements_current"))


def q_sales_pipeline(spark, sf):
    return tables.read_latest(spark, _sales_root(spark, sf), "sales_stats")


def q_sales_pipeline_incremental(spark, sf):
    root = _run_once(spark, sf, "sales_rounds", lambda r: sales_in_rounds(spark, sf, r))
    return tables.read_latest(spark, root, "sales_stats")


def q_sales_pipeline_expectations(spark, sf):
    return tables.read_latest(spark, _sales_root(spark, sf), "sales_stats_expectations")


def q_fraud_pipeline(spark, sf):
    return tables.read_latest(spark, _fraud_root(spark, sf), "fraud_by_party_and_method")


def q_fraud_pipeline_bookings_with_fraud(spark, sf):
    return tables.read_latest(spark, _fraud_root(spark, sf), "bookings_with_fraud")


def q_fraud_flags_stream(spark, sf):
    return (read_table(spark, _fraud_root(spark, sf), "fraud_flags")
            .filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record"))


def q_bookings_scd1_stream(spark, sf):
    root = _run_once(spark, sf, "bookings_rounds", lambda r: bookings_in_rounds(spark, sf, r))
    return Scd1Flow(root, "bookings", ["booking_id"], td.BOOKING_SEQUENCE).read(spark)


def _history_flow(spark, sf) -> Scd2Flow:
    root = _run_once(spark, sf, "history_rounds", lambda r: history_in_rounds(spark, sf, r))
    return Scd2Flow(root, "events_history", ["user_id"], "event_id")


def q_events_scd2_stream(spark, sf):
    return _history_flow(spark, sf).read(spark)


def q_events_as_of_stream(spark, sf):
    from tierline.operators.cdc import as_of
    from tierline.plans.history import midpoint
    return as_of(_history_flow(spark, sf).read(spark), midpoint(td.table(spark, sf, "events")))


def q_medallion_pipeline(spark, sf):
    return tables.read_latest(spark, _medallion_root(spark, sf), "zone_stats_gold")


def q_sensor_state_silver_stream(spark, sf):
    root = _medallion_root(spark, sf)
    return Scd1Flow(root, "sensor_state_silver", ["sensor_id"], "reading_seq").read(spark)


def q_sensor_zone_silver_stream(spark, sf):
    root = _medallion_root(spark, sf)
    return Scd1Flow(root, "sensor_zone_silver", ["sensor_id"], sensors.ZONE_SEQUENCE).read(spark)


def q_measurements_stream_expectations(spark, sf):
    return tables.read_latest(spark, _measurements_root(spark, sf), "measurements_expectations")


def q_sensor_readings_expectations(spark, sf):
    return tables.read_latest(spark, _medallion_root(spark, sf), "sensor_readings_expectations")


def q_measurements_stream(spark, sf):
    return ingest.as_double(read_table(spark, _measurements_root(spark, sf), "measurements"))


def q_measurements_stream_lookup(spark, sf):
    """The ingest smoke check: the record with a given id, found by a filter
    that reaches the parquet scan of the stored table."""
    return ingest.as_double(read_table(spark, _measurements_root(spark, sf), "measurements")
                            .filter(ingest.id_is("42")))


def q_measurements_stream_after_delete(spark, sf):
    return ingest.as_double(
        tables.read_latest(spark, _measurements_root(spark, sf), "measurements_current"))


def q_fraud_pipeline_row_counts(spark, sf):
    root = _fraud_root(spark, sf)
    flags = read_table(spark, root, "fraud_flags").filter(F.col("_corrupt_record").isNull())
    return sensors.row_counts({
        "booking_updates": read_table(spark, root, "booking_updates"),
        "bookings": Scd1Flow(root, "bookings", ["booking_id"], td.BOOKING_SEQUENCE).read(spark),
        "fraud_flags": flags,
        "payments": read_table(spark, root, "payments"),
        "bookings_with_fraud": tables.read_latest(spark, root, "bookings_with_fraud"),
        "fraud_by_party_and_method": tables.read_latest(spark, root, "fraud_by_party_and_method")})


def q_medallion_pipeline_row_counts(spark, sf):
    root = _medallion_root(spark, sf)
    return sensors.row_counts({
        "sensor_readings_bronze": read_table(spark, root, "sensor_readings_bronze"),
        "sensor_registry_bronze": read_table(spark, root, "sensor_registry_bronze"),
        "sensor_state_silver": Scd1Flow(root, "sensor_state_silver", ["sensor_id"],
                                        "reading_seq").read(spark),
        "sensor_zone_silver": Scd1Flow(root, "sensor_zone_silver", ["sensor_id"],
                                       sensors.ZONE_SEQUENCE).read(spark),
        "zone_stats_gold": tables.read_latest(spark, root, "zone_stats_gold")})


def q_payments_stream_by_name(spark, sf):
    """A streaming table read as a stream by its catalog name into another one."""
    def go(r):
        pays = td.payments(spark, sf, orders=stream_files(
            spark, f"{sf}/orders.parquet", td.table(spark, sf, "orders").schema))
        append_stream(pays, r, "payments").awaitTermination()
        name = name_table(spark, r, "payments", "payments_" + r.rsplit("-", 1)[1])
        append_stream(stream_by_name(spark, name), r, "payments_copy").awaitTermination()
    return read_table(spark, _run_once(spark, sf, "payments_by_name", go), "payments_copy")


def q_sales_pipeline_late_orders(spark, sf):
    """The line items arrive when two thirds of the orders are missing; the
    view that follows the other orders holds them all."""
    def go(r):
        early = f"{r}/early"
        for name in ("lineitem", "part"):
            td.table(spark, sf, name).write.parquet(f"{early}/{name}.parquet")
        orders = td.table(spark, sf, "orders")
        first = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
        orders.filter(first).write.parquet(f"{early}/orders.parquet")
        sales_pipeline(spark, early, r)
        orders.filter(~first).write.mode("append").parquet(f"{early}/orders.parquet")
        sales_pipeline(spark, early, r)
    return tables.read_latest(spark, _run_once(spark, sf, "sales_late", go), "sales_stats")


STREAMING_QUERIES = {
    "payments_stream_by_name": q_payments_stream_by_name,
    "sales_pipeline_late_orders": q_sales_pipeline_late_orders,
    "sales_pipeline": q_sales_pipeline,
    "sales_pipeline_expectations": q_sales_pipeline_expectations,
    "sales_pipeline_incremental": q_sales_pipeline_incremental,
    "sales_pipeline_rerun": q_sales_pipeline_rerun,
    "sales_incremental_after_full_refresh": q_sales_incremental_after_full_refresh,
    "fraud_pipeline_rerun": q_fraud_pipeline_rerun,
    "measurements_delete_then_ingest": q_measurements_delete_then_ingest,
    "measurements_stream_expectations": q_measurements_stream_expectations,
    "sensor_zone_silver_stream": q_sensor_zone_silver_stream,
    "fraud_pipeline": q_fraud_pipeline,
    "fraud_pipeline_bookings_with_fraud": q_fraud_pipeline_bookings_with_fraud,
    "fraud_flags_stream": q_fraud_flags_stream,
    "fraud_pipeline_row_counts": q_fraud_pipeline_row_counts,
    "bookings_scd1_stream": q_bookings_scd1_stream,
    "events_scd2_stream": q_events_scd2_stream,
    "events_as_of_stream": q_events_as_of_stream,
    "medallion_pipeline": q_medallion_pipeline,
    "sensor_state_silver_stream": q_sensor_state_silver_stream,
    "medallion_pipeline_row_counts": q_medallion_pipeline_row_counts,
    "sensor_readings_expectations": q_sensor_readings_expectations,
    "measurements_stream": q_measurements_stream,
    "measurements_stream_lookup": q_measurements_stream_lookup,
    "measurements_stream_after_delete": q_measurements_stream_after_delete,
}


def _streaming_oracle() -> dict:
    from tierline import oracle as o
    return {
        "payments_stream_by_name": """SELECT o_orderkey AS booking_id, o_orderpriority AS payment_method,
                                      o_totalprice AS amount, o_orderdate AS paid_at FROM orders""",
        "sales_pipeline_late_orders": o.ORACLE_SQL["sales_stats"],
        "sales_pipeline": o.ORACLE_SQL["sales_stats"],
        "sales_pipeline_expectations": o.ORACLE_SQL["sales_stats_expectations"],
        "sales_pipeline_incremental": o.ORACLE_SQL["sales_stats"],
        "sales_pipeline_rerun": o.ORACLE_SQL["sales_stats"],
        "sales_incremental_after_full_refresh": o.ORACLE_SQL["sales_stats"],
        "fraud_pipeline_rerun": o.ORACLE_SQL["fraud_by_party_and_method"],
        "measurements_delete_then_ingest": o.ORACLE_SQL["measurements_after_delete"],
        "measurements_stream_expectations": o.MEASUREMENTS_EXPECTATIONS,
        "sensor_zone_silver_stream": o.ORACLE_SQL["sensor_zone_silver"],
        "fraud_pipeline": o.ORACLE_SQL["fraud_by_party_and_method"],
        "fraud_pipeline_bookings_with_fraud": o.ORACLE_SQL["bookings_with_fraud"],
        "fraud_flags_stream": o.ORACLE_SQL["fraud_flags"],
        "fraud_pipeline_row_counts": o.ORACLE_SQL["fraud_row_counts"],
        "bookings_scd1_stream": o.ORACLE_SQL["bookings_scd1"],
        "events_scd2_stream": o.ORACLE_SQL["events_scd2"],
        "events_as_of_stream": o.ORACLE_SQL["events_as_of"],
        "medallion_pipeline": o.ORACLE_SQL["zone_stats_gold"],
        "sensor_state_silver_stream": o.ORACLE_SQL["sensor_state_silver"],
        "medallion_pipeline_row_counts": o.ORACLE_SQL["medallion_row_counts"],
        "sensor_readings_expectations": o.READINGS_EXPECTATIONS,
        "measurements_stream": o.ORACLE_SQL["measurements"],
        "measurements_stream_lookup": o.MEASUREMENT_LOOKUP,
        "measurements_stream_after_delete": o.ORACLE_SQL["measurements_after_delete"],
    }


STREAMING_ORACLE = _streaming_oracle()
