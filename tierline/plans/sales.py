"""Sales KPIs per product with three expectations (log / drop / fail).

sales_transactions (streaming table) -> sales_stats (materialized view):

    product, txn_count, units_sold, gross_revenue, avg_txn_value,
    unique_customers, franchises_selling

The two exact distinct counts plan as Expand + a four-step aggregate: partial
aggregates on (product, value) before every shuffle, so a product holding a
third of all rows never lands in one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.functions.scalar import round_avg, round_sum
from tierline.operators.expectations import (
    Expectation, apply_expectations, expectation_report,
)

# fixed values: the three constraints of the workshop's sales view
SALES_EXPECTATIONS = [
    Expectation("reasonable_avg_value", "avg_txn_value BETWEEN 1 AND 1000", "log"),
    Expectation("nonneg_revenue", "gross_revenue >= 0", "drop"),
    Expectation("known_product", "product IS NOT NULL", "fail"),
]


def sales_aggregate(tx: DataFrame) -> DataFrame:
    return tx.groupBy("product").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("quantity").alias("units_sold"),
        round_sum("totalPrice").alias("gross_revenue"),
        round_avg("totalPrice").alias("avg_txn_value"),
        F.count_distinct("customerID").alias("unique_customers"),
        F.count_distinct("franchiseID").alias("franchises_selling"))


def sales_stats(tx: DataFrame, expectations=None) -> tuple[DataFrame, Observation]:
    """The gated view and the Observation with its expectation counts."""
    return apply_expectations(sales_aggregate(tx),
                              SALES_EXPECTATIONS if expectations is None else expectations,
                              name="sales_stats")


def sales_stats_report(tx: DataFrame, expectations=None) -> DataFrame:
    return expectation_report(sales_aggregate(tx),
                              SALES_EXPECTATIONS if expectations is None else expectations,
                              "sales_stats")


def min_avg_value_expectation(threshold: float) -> Expectation:
    """DROP groups whose average transaction value is below ``threshold``."""
    return Expectation("min_avg_value", f"avg_txn_value >= {float(threshold)!r}", "drop")
