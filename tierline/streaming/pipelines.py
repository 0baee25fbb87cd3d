"""The workshop's pipelines run end to end on Structured Streaming.

Each runner ingests through append-only streaming tables (bronze), upserts
with ``Scd1Flow`` (silver), and publishes materialized views as versioned
Parquet (gold). ``trigger='availableNow'`` is the triggered update: process
all available input, refresh the views, stop. A processing-time trigger is
the continuous mode: the same definitions, bronze flows keep running and the
views are refreshed on an interval until a stop event is set (``run_until``).

All data goes below a run folder in the session's checkpoint directory.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import tables
from tierline.operators.expectations import VIOLATIONS, observation_report
from tierline.operators.maintenance import dedupe
from tierline.plans import fraud, ingest, sales, seed, sensors
from tierline.sources import testdata as td
from tierline.streaming.checks import flag, passing, stored_report
from tierline.streaming.incremental import PartialsFlow
from tierline.streaming.tables import append_stream, data_path, read_table, read_table_stream, stream_files
from tierline.streaming.upsert import Scd1Flow

FLAGS_SCHEMA = fraud.FLAG_SCHEMA + ", _corrupt_record string"


def _source(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    schema = td.table(spark, sf_dir, name).schema
    return stream_files(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", schema, max_files=max_files)


def _wait(*queries):
    for q in queries:
        q.awaitTermination()


def committed(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a streaming table holds a committed batch."""
    path = data_path(spark, root, name)
    return path is not None and tables.exists(spark, path + "/_spark_metadata/0")


def run_until(queries, refresh, interval_s: float, stop: threading.Event | None = None,
              rounds: int | None = None) -> None:
    """Calls ``refresh`` every ``interval_s`` seconds while the flows run,
    until ``stop`` is set (or ``rounds`` times), then stops them. A flow that
    died raises its error."""
    def raise_failed():
        for q in queries:
            if q.exception() is not None:
                raise q.exception()

    stop, done = stop or threading.Event(), 0
    try:
        while not stop.is_set() and (rounds is None or done < rounds):
            stop.wait(interval_s)
            raise_failed()
            refresh()
            done += 1
        raise_failed()
    finally:
        for q in queries:
            q.stop()


# ---- L2: sales -----------------------------------------------------------------
def _sales_dimensions(spark: SparkSession, sf_dir: str, root: str) -> tuple[DataFrame, DataFrame]:
    """The tables every micro-batch of line items joins with, bucketed once on
    their keys: each batch then shuffles only its own rows (when they are too
    large to broadcast)."""
    orders = tables.bucketed_copy(td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
                                  root, "orders_by_orderkey", ["o_orderkey"])
    part = tables.bucketed_copy(td.table(spark, sf_dir, "part").select("p_partkey", "p_type"),
                                root, "part_by_partkey", ["p_partkey"])
    return orders, part


def sales_ingest(spark: SparkSession, sf_dir: str, root: str, trigger: str = "availableNow",
                 full_refresh: bool = False, max_files: int | None = None) -> list:
    """The bronze flow of the sales pipeline, started. Every line item is
    stored; one whose order or part is not in the tables yet waits there with
    its keys (``_pending``)."""
    orders, part = _sales_dimensions(spark, sf_dir, root)
    tx = td.sales_transactions(spark, sf_dir, orders=orders, part=part,
                               lineitem=_source(spark, sf_dir, "lineitem", max_files), waiting=True)
    return [append_stream(tx, root, "sales_transactions", trigger, full_refresh)]


def settled_sales(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The complete transactions: those stored complete, and the waiting line
    items whose order and part are there now. The few waiting rows are joined
    with the tables as they are at each read, so nothing has to be moved."""
    stored = read_table(spark, root, "sales_transactions")
    complete = stored.filter(F.col(td.PENDING).isNull()).drop(td.PENDING)
    late = td.late_transactions(spark, sf_dir, stored)
    return complete if late is None else complete.unionByName(late)


def sales_refresh(spark: SparkSession, sf_dir: str, root: str) -> dict:
    """sales_stats (view with expectations) and its expectation report from
    what bronze committed and the orders and parts of this moment. A FAIL expectation raises and leaves the previous
    sales_stats version current."""
    if not committed(spark, root, "sales_transactions"):
        return {}
    stats, obs = sales.sales_stats(settled_sales(spark, sf_dir, root))
    v = tables.publish(stats, root, "sales_stats")
    report = observation_report(spark, obs, sales.SALES_EXPECTATIONS, "sales_stats")
    tables.publish(report, root, "sales_stats_expectations")
    return {"sales_stats": v}


def sales_pipeline(spark: SparkSession, sf_dir: str, root: str, full_refresh: bool = False,
                   max_files: int | None = None) -> dict:
    """One triggered update: all available line items, then the view."""
    _wait(*sales_ingest(spark, sf_dir, root, "availableNow", full_refresh, max_files))
    return sales_refresh(spark, sf_dir, root)


def sales_continuous(spark: SparkSession, sf_dir: str, root: str, interval_s: float = 5.0,
                     stop: threading.Event | None = None, rounds: int | None = None) -> None:
    """Bronze runs on an interval and the view follows until ``stop`` is set."""
    run_until(sales_ingest(spark, sf_dir, root, f"{interval_s} seconds"),
              lambda: sales_refresh(spark, sf_dir, root), interval_s, stop, rounds)


# ---- L3: fraud -----------------------------------------------------------------
def seed_landing(spark: SparkSession, sf_dir: str, root: str, pct: float = 3.0,
                 n_files: int = 5, again: bool = False) -> str:
    """Seeds the landing folder once; ``again`` replaces what it holds (files
    of new names, so the flags table then needs a full refresh)."""
    path = f"{root.rstrip('/')}/landing/booking_fraud_flags"
    if not again and tables.exists(spark, path + "/_SUCCESS"):
        return path
    markers = seed.fraud_markers(td.booking_updates(spark, sf_dir), pct,
                                 method="portable", digest="portable")
    seed.write_markers(markers, path, n_files)
    return path


def fraud_ingest(spark: SparkSession, sf_dir: str, root: str, landing: str,
                 trigger: str = "availableNow", refresh_flags: bool = False) -> list:
    """The three bronze flows, started together."""
    updates = td.booking_updates(spark, sf_dir, lineitem=_source(spark, sf_dir, "lineitem"))
    flags = stream_files(spark, landing, FLAGS_SCHEMA, fmt="json",
                         options={"columnNameOfCorruptRecord": "_corrupt_record"})
    pays = td.payments(spark, sf_dir, orders=_source(spark, sf_dir, "orders"))
    return [append_stream(updates, root, "booking_updates", trigger),
            append_stream(flags, root, "fraud_flags", trigger, refresh_flags),
            append_stream(pays, root, "payments", trigger)]


def fraud_refresh(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """Silver and gold from the bronze tables. Bookings (SCD1 state), the
    silver view and the counts of flags and payments per booking (kept
    incrementally) are all bucketed on booking_id with the bookings state's
    bucket count, so they meet without a shuffle. The gold view is advanced by
    the bookings that changed (``_fraud_counts``). Nothing happens until all
    three bronze tables hold a commit."""
    if not all(committed(spark, root, t) for t in ("booking_updates", "fraud_flags", "payments")):
        return
    flow = Scd1Flow(root, "bookings", ["booking_id"], td.BOOKING_SEQUENCE, buckets)
    source = data_path(spark, root, "booking_updates")
    flow.declare(spark, spark.read.parquet(source).schema)
    buckets = flow.resolve_buckets(spark)
    pays = PartialsFlow(root, "payment_counts", ["booking_id", "payment_method"],
                        {"_np": ("count", "*")}, buckets, bucket_by=["booking_id"])
    marks = PartialsFlow(root, "flag_counts", ["booking_id"], fraud.flag_partials(), buckets,
                         only=F.col("_corrupt_record").isNull())
    with ThreadPoolExecutor(max_workers=2) as pool:      # independent of the bookings
        counted = [pool.submit(f.run, spark, data_path(spark, root, t))
                   for f, t in ((pays, "payments"), (marks, "fraud_flags"))]
        flow.run(spark, source)
        flags = read_table(spark, root, "fraud_flags").filter(F.col("_corrupt_record").isNull())
        for c in counted:
            c.result()
    hot = fraud.hot_bookings(flags, buckets, counts=marks.read(spark))
    bwf = fraud.bookings_with_fraud(flow.read(spark), flags.drop("_corrupt_record"), hot)
    if hot:             # a bucket would gather a hot booking's rows again
        tables.publish(bwf, root, "bookings_with_fraud")
    else:
        tables.publish_bucketed(bwf, root, "bookings_with_fraud", ["booking_id"], buckets, aligned=True)
    inputs = [f.current_version(spark) for f in (flow, marks, pays)]
    v = tables.publish(fraud.with_rate(_fraud_counts(spark, root, flow, marks, pays)), root,
                       "fraud_by_party_and_method")
    tables.publish(spark.createDataFrame([(v, *inputs)], FRAUD_INPUTS), root, "fraud_gold_inputs")


FRAUD_INPUTS = "gold_version int, bookings int, flags int, payments int"


def _fraud_counts(spark: SparkSession, root: str, *states) -> DataFrame:
    """Counts of the fraud gold view. From the last view and the versions of
    the ``states`` (bookings, flags, payments) it was made from: only bookings
    that a merge touched since are read, as they were and as they are. Over all
    bookings where there is no such view (first run, a state loaded anew or
    folded, a crash before the versions were noted)."""
    made = tables.read_latest(spark, root, "fraud_gold_inputs")
    row = None if made is None else made.first()
    touched = [None]
    if row is not None and row.gold_version == tables.latest_version(
            spark, root, "fraud_by_party_and_method"):
        touched = [f.changed_since(spark, v) for f, v in zip(states, row[1:], strict=True)]
    if any(t is None for t in touched):
        return fraud.pair_counts(*[f.read(spark) for f in states])
    ids = touched[0].select("booking_id")
    for t in touched[1:]:
        ids = ids.unionByName(t.select("booking_id"))
    ids = ids.distinct()
    before, after = (fraud.pair_counts(*[f.read(spark, version=v).join(ids, "booking_id", "left_semi")
                                         for f, v in zip(states, versions, strict=True)])
                     for versions in (row[1:], [None] * len(states)))
    gold = tables.read_version(spark, root, "fraud_by_party_and_method", row.gold_version)
    return fraud.retracted(gold, before, after)


def fraud_pipeline(spark: SparkSession, sf_dir: str, root: str, pct: float = 3.0,
                   n_files: int = 5, reseed: bool = False) -> None:
    """One triggered update. Flags are seeded on the first run only, so a rerun
    delivers none twice; ``reseed`` draws them anew and reloads their table."""
    landing = seed_landing(spark, sf_dir, root, pct, n_files, reseed)
    _wait(*fraud_ingest(spark, sf_dir, root, landing, refresh_flags=reseed))
    fraud_refresh(spark, root)


def fraud_continuous(spark: SparkSession, sf_dir: str, root: str, interval_s: float = 5.0,
                     stop: threading.Event | None = None, rounds: int | None = None) -> None:
    """Bronze runs on an interval, silver and gold follow until ``stop`` is set."""
    landing = seed_landing(spark, sf_dir, root)
    run_until(fraud_ingest(spark, sf_dir, root, landing, f"{interval_s} seconds"),
              lambda: fraud_refresh(spark, root), interval_s, stop, rounds)


# ---- L4: continuous medallion ----------------------------------------------------
# fixed values: the live feed rates (rows per second) of readings and registry
FEED_RATES = (10, 2)


def medallion_feeds(spark: SparkSession, sf_dir: str | None, source: str = "events",
                    rates: tuple[int, int] = FEED_RATES) -> tuple[DataFrame, DataFrame]:
    """(readings feed, registry feed) as streams. 'events': from the events
    table, as in batch; 'rate': the live generators
    (10 and 2 rows/s by default)."""
    if source == "events":
        ev = _source(spark, sf_dir, "events")
        return td.readings_feed(spark, sf_dir, events=ev), td.registry_feed(spark, sf_dir, events=ev)
    if source == "rate":
        r = spark.readStream.format("rate").option("rowsPerSecond", str(rates[0])).load()
        g = spark.readStream.format("rate").option("rowsPerSecond", str(rates[1])).load()
        return r, g
    raise ValueError(f"source must be 'events' or 'rate', got {source!r}")


class Medallion:
    """Bronze flows + silver upserts + gold view of the sensor pipeline."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.state = Scd1Flow(root, "sensor_state_silver", ["sensor_id"], "reading_seq")
        self.zones = Scd1Flow(root, "sensor_zone_silver", ["sensor_id"], sensors.ZONE_SEQUENCE)
        self.queries = []

    def start(self, readings_feed: DataFrame, registry_feed: DataFrame,
              trigger: str = "availableNow") -> Medallion:
        readings = flag(sensors.readings_bronze(readings_feed, seed=7), sensors.READINGS_EXPECTATIONS)
        registry = sensors.registry_bronze(registry_feed)
        # the silvers exist (empty) before the first refresh
        self.state.declare(self.spark, readings.drop(VIOLATIONS).schema)
        self.zones.declare(self.spark, registry.schema)
        self.queries = [
            append_stream(readings, self.root, "sensor_readings_bronze", trigger),
            append_stream(registry, self.root, "sensor_registry_bronze", trigger)]
        return self

    def refresh(self) -> None:
        """Silver upserts from whatever bronze committed, then the gold view."""
        with ThreadPoolExecutor(max_workers=2) as pool:      # the silvers are independent
            runs = [pool.submit(flow.run, self.spark, p)
                    for flow, bronze in ((self.state, "sensor_readings_bronze"),
                                         (self.zones, "sensor_registry_bronze"))
                    if (p := data_path(self.spark, self.root, bronze)) is not None]
            for r in runs:
                r.result()
        # the gold view is recomputed when either silver moved past the
        # versions it was built from, once both hold merged data
        inputs = (self.state.current_version(self.spark) or 0,
                  self.zones.current_version(self.spark) or 0)
        if min(inputs) > 0 and inputs != self.gold_inputs():
            gold = sensors.zone_stats_gold(self.state.read(self.spark), self.zones.read(self.spark))
            v = tables.publish(gold, self.root, "zone_stats_gold")
            tables.publish(self.spark.createDataFrame([(v, *inputs)], self.INPUTS), self.root,
                           "zone_stats_gold_inputs")

    INPUTS = "gold_version int, state_version int, zone_version int"

    def gold_inputs(self) -> tuple[int, int] | None:
        """The silver versions behind the last gold view, as stored with it."""
        made = tables.read_latest(self.spark, self.root, "zone_stats_gold_inputs")
        row = None if made is None else made.first()
        return None if row is None else (row.state_version, row.zone_version)

    def run_triggered(self) -> None:
        _wait(*self.queries)
        self.refresh()

    def run_continuous(self, interval_s: float, rounds: int | None = None, keep: int = 3,
                       stop: threading.Event | None = None) -> None:
        """Refreshes silver and gold every ``interval_s`` seconds while the
        bronze flows run, until ``stop`` is set (or ``rounds`` times); a flow
        that died raises. Only the newest ``keep`` versions of the silvers and
        the gold view are kept."""
        def step():
            self.refresh()
            self.state.retain(self.spark, keep)
            self.zones.retain(self.spark, keep)
            for name in ("zone_stats_gold", "zone_stats_gold_inputs"):
                tables.retain(self.spark, self.root, name, keep)
        try:
            run_until(self.queries, step, interval_s, stop, rounds)
        finally:
            self.stop()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def expectation_report(self) -> DataFrame:
        """Counts of the readings expectation over all committed readings."""
        return stored_report(self.spark, self.root, "sensor_readings_bronze",
                             sensors.READINGS_EXPECTATIONS)


# ---- L1: ingest ------------------------------------------------------------------
REMEMBERED = "7 days"       # how long a producer may repeat a record


def ingest_landing(spark: SparkSession, landing: str, root: str,
                   within: str | None = REMEMBERED) -> None:
    """The landed JSON lines so far into ``measurements``, one row per id.
    Every parsed line is kept with its violations in ``measurements_landed``;
    lines that do not parse and records that fail a check go on to
    ``measurements_set_aside``, the others to ``measurements``. The counts over
    the landed lines are published as ``measurements_expectations``. A crash
    between any two steps is made good by the next call. Ids are remembered for
    ``within`` after their ingest, which bounds the state; None: for ever."""
    schema = T.StructType([*ingest.MEASUREMENTS_SCHEMA.fields,
                           T.StructField("_corrupt_record", T.StringType())])
    parsed = stream_files(spark, landing, schema, fmt="json",
                          options={"columnNameOfCorruptRecord": "_corrupt_record"})
    checks = ingest.LANDING_EXPECTATIONS
    landed = flag(parsed, checks)
    _wait(append_stream(landed, root, "measurements_landed"))
    stored = read_table_stream(spark, root, "measurements_landed", landed.schema)
    good = passing(stored, checks).drop("_corrupt_record")
    if within:
        good = dedupe(good.withColumn("_ingested", F.current_timestamp()), ["id"], "_ingested",
                      within).drop("_ingested")
    else:
        good = dedupe(good, ["id"])
    bad = stored.filter(F.col(VIOLATIONS) != 0).drop(VIOLATIONS)
    _wait(append_stream(good, root, "measurements"), append_stream(bad, root, "measurements_set_aside"))
    tables.publish(stored_report(spark, root, "measurements_landed", checks, "measurements"),
                   root, "measurements_expectations")


def measurements_pipeline(spark: SparkSession, sf_dir: str, root: str, producers: int = 2) -> None:
    """Every producer delivers all records (at-least-once) as JSON lines."""
    landing = f"{root.rstrip('/')}/landing/measurements"
    recs = td.measurement_records(spark, sf_dir)
    for _ in range(producers):
        ingest.land(recs, landing)
    ingest_landing(spark, landing, root)


def _deletable(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """The stored rows with their place: file and row number within it."""
    rows = tables.read_latest(spark, root, name)
    if rows is None:
        rows = read_table(spark, root, name, schema)
        if data_path(spark, root, name) is None:                 # nothing stored, no places
            return rows.withColumn("_file", F.lit("")).withColumn("_row", F.lit(0).cast("long"))
    return rows.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))


def remaining(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """The rows of a table that no delete has removed, as they are now."""
    rows = _deletable(spark, root, name, schema)
    gone = f"{root.rstrip('/')}/{name}_deleted_rows"
    if tables.exists(spark, gone + "/_SUCCESS"):
        gone = spark.read.schema("_file string, _row bigint").parquet(gone)
        rows = rows.join(gone, ["_file", "_row"], "left_anti")
    return rows.drop("_file", "_row")


def delete_from(spark: SparkSession, root: str, name: str, predicate: str, schema=None) -> int:
    """DELETE FROM name WHERE predicate (SQL text). The table itself is append
    only: the places (file, row number) of the rows that match now are added to
    ``<name>_deleted_rows``, in one commit, and what is left is published as
    ``<name>_current``. A row that comes later stays, whatever its values; a
    delete that is run again finds nothing more to remove."""
    hits = _deletable(spark, root, name, schema).filter(F.coalesce(F.expr(predicate), F.lit(False)))
    (hits.select("_file", "_row").write.mode("append")
         .parquet(f"{root.rstrip('/')}/{name}_deleted_rows"))
    return tables.publish(remaining(spark, root, name, schema), root, name + "_current")


# ---- the catalog -----------------------------------------------------------------
COMMENTS = {
    "sales_stats": "Sales figures per product, products without revenue dropped",
    "bookings_with_fraud": "Current bookings with their fraud flag",
    "fraud_by_party_and_method": "Payments and frauds per party size and payment method",
    "zone_stats_gold": "Current sensors and temperatures per zone",
    "measurements_current": "Ingested measurements without the deleted ones",
}


def register_published(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Names the newest version of every published view below ``root`` in the
    catalog, with comment and properties; returns the names."""
    out = []
    for name, comment in COMMENTS.items():
        v = tables.latest_version(spark, root, name)
        if v is not None:
            tables.register(spark, prefix + name, tables.version_path(root, name, v), comment,
                            {"quality": "gold", "version": str(v)})
            out.append(prefix + name)
    return out
