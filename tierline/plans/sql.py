"""Some views as Spark SQL over catalog tables.

The inputs are published below a working folder and registered in the catalog
under names of their own run; the statements read them by name. They reduce
before they join, so they hold up under the same skew as the DataFrame forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline import tables
from tierline.plans import fraud
from tierline.plans.seed import fraud_markers
from tierline.session import work_root
from tierline.sources import testdata as td

SALES_STATS = """
WITH spent AS (
  SELECT product, customerID, count(*) AS n, sum(quantity) AS units, count(totalPrice) AS priced,
         sum(CAST(totalPrice AS DECIMAL(30,10))) AS amount
  FROM {sales_transactions} GROUP BY product, customerID),
shops AS (
  SELECT product, count(franchiseID) AS franchises_selling
  FROM (SELECT DISTINCT product, franchiseID FROM {sales_transactions}) GROUP BY product)
SELECT product, sum(n) AS txn_count, sum(units) AS units_sold,
       CAST(round(sum(amount), 2) AS DOUBLE) AS gross_revenue,
       CAST(round(sum(amount) / sum(priced), 2) AS DOUBLE) AS avg_txn_value,
       count(customerID) AS unique_customers, first(franchises_selling) AS franchises_selling
FROM spent JOIN shops USING (product) GROUP BY product
"""

FRAUD_BY_PARTY_AND_METHOD = """
WITH paid AS (
  SELECT booking_id, payment_method, count(*) AS times FROM {payments} GROUP BY ALL),
flagged AS (
  SELECT booking_id, count(*) AS flags, count_if(flag = 'fraud') AS bad
  FROM {fraud_flags} GROUP BY booking_id),
weighed AS (
  SELECT guests_count, payment_method, times * coalesce(flags, 1) AS pairs,
         times * coalesce(bad, 0) AS frauds
  FROM {bookings} JOIN paid USING (booking_id) LEFT JOIN flagged USING (booking_id))
SELECT guests_count AS party_size, payment_method, sum(pairs) AS total_bookings,
       sum(frauds) AS fraud_count,
       CAST(round(100.0 * sum(frauds) / sum(pairs), 2) AS DOUBLE) AS fraud_rate_pct
FROM weighed GROUP BY ALL
"""

def _inputs(spark: SparkSession, sf_dir: str) -> dict:
    """The tables the statements may name, as functions."""
    updates = td.booking_updates(spark, sf_dir)
    return {
        "sales_transactions": lambda: td.sales_transactions(spark, sf_dir),
        "bookings": lambda: fraud.bookings(updates),
        "fraud_flags": lambda: fraud_markers(updates, 3.0, method="portable", digest="portable"),
        "payments": lambda: td.payments(spark, sf_dir),
    }


def run(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """Publishes and registers the tables the statement names, then runs it."""
    root = work_root(spark, "sql")
    tag = root.rsplit("-", 1)[1]
    names = {}
    for name, make in _inputs(spark, sf_dir).items():
        if "{" + name + "}" in statement:
            names[name] = f"{name}_{tag}"
            tables.publish_table(make(), root, names[name])
    return spark.sql(statement.format(**names))
