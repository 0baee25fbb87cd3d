"""The workshop's input datasets, derived from the given parquet tables.

Every function returns a lazy DataFrame over whole tables; only the columns a
dataset needs are selected so the parquet scan reads just those.

| workshop input      | derived from                                        |
| sales_transactions  | lineitem ⋈ orders ⋈ part                            |
| booking_updates     | lineitem (key l_orderkey, several updates per key)  |
| payments            | orders                                              |
| readings feed       | events, one tick per event                          |
| registry feed       | events, one tick per five events, reported by each  |
| measurement records | events ⋈ customer ⋈ nation                          |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# sequence of one booking update: lexicographic over these columns
BOOKING_SEQUENCE = ["update_line", "update_part", "update_supp", "quantity", "amount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# what a line item still waits for: null once it is complete
PENDING = "_pending"


def sales_transactions(spark: SparkSession, sf_dir: str, product: str = "p_type",
                       lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                       part: DataFrame | None = None, waiting: bool = False) -> DataFrame:
    """product, quantity, totalPrice, customerID, franchiseID; ``product`` is
    the part column that names the product (p_type: 6 values, p_brand: 25).
    ``waiting`` keeps the line items whose order or part is not there yet, with
    the keys they wait for in ``_pending`` (null in complete rows)."""
    li = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    o = (orders if orders is not None else table(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey")
    p = (part if part is not None else table(spark, sf_dir, "part")).select("p_partkey", product)
    how = "left" if waiting else "inner"
    keys = F.when(F.col("o_orderkey").isNull() | F.col("p_partkey").isNull(),
                  F.struct("l_orderkey", "l_partkey")).alias(PENDING)
    return (li.join(o, li.l_orderkey == o.o_orderkey, how)
              .join(p, li.l_partkey == p.p_partkey, how)
              .select(F.col(product).alias("product"),
                      F.col("l_quantity").alias("quantity"),
                      F.col("l_extendedprice").alias("totalPrice"),
                      F.col("o_custkey").alias("customerID"),
                      F.col("l_suppkey").alias("franchiseID"), *([keys] if waiting else [])))


def late_transactions(spark: SparkSession, sf_dir: str, stored: DataFrame,
                      product: str = "p_type") -> DataFrame | None:
    """The transactions among the stored waiting rows whose order and part
    have come since; None when no row waits."""
    waiting = stored.filter(F.col(PENDING).isNotNull())
    if waiting.isEmpty():
        return None
    items = waiting.select(
        f"{PENDING}.*", F.col("franchiseID").alias("l_suppkey"), F.col("quantity").alias("l_quantity"),
        F.col("totalPrice").alias("l_extendedprice"))
    return sales_transactions(spark, sf_dir, product, lineitem=items)


def booking_updates(spark: SparkSession, sf_dir: str,
                    lineitem: DataFrame | None = None) -> DataFrame:
    """CDC feed: booking_id key, sequence BOOKING_SEQUENCE, guests_count payload."""
    src = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    return src.select(
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_linenumber").alias("update_line"),
        F.col("l_partkey").alias("update_part"),
        F.col("l_suppkey").alias("update_supp"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        ((F.col("l_quantity") % 6).cast("int") + 1).alias("guests_count"))


def payments(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    src = orders if orders is not None else table(spark, sf_dir, "orders")
    return src.select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("paid_at"))


def readings_feed(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Rate-shaped feed (timestamp, value) plus the measured reading."""
    src = events if events is not None else table(spark, sf_dir, "events")
    return src.select(
        F.col("ts").alias("timestamp"), F.col("event_id").alias("value"),
        F.col("value").alias("reading"))


def registry_feed(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Rate-shaped feed of registry ticks, for batch and stream alike: every
    event reports the tick it belongs to (event_id div 5), so five reports per
    tick, ordered by ``event``."""
    src = events if events is not None else table(spark, sf_dir, "events")
    return src.select(F.col("ts").alias("timestamp"), F.expr("event_id div 5").alias("value"),
                      F.col("event_id").alias("event"))


def measurement_records(spark: SparkSession, sf_dir: str,
                        events: DataFrame | None = None) -> DataFrame:
    """id, city, temperature, comment as one producer would send them."""
    src = events if events is not None else table(spark, sf_dir, "events")
    ev = src.select("event_id", "user_id", "value", "event_type")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (ev.join(c, ev.user_id == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .select(F.col("event_id").cast("string").alias("id"),
                      F.col("n_name").alias("city"),
                      F.col("value").cast("float").alias("temperature"),
                      F.col("event_type").alias("comment")))
