"""Incrementally maintained views (only new rows are processed on refresh).

A view over COUNT / SUM / AVG / MIN / MAX keeps mergeable partials per group
(``PartialsFlow``); an exact COUNT(DISTINCT v) keeps the set of distinct
(group, v) pairs (``DistinctFlow``), bucketed on the pair so a large group
spreads over all buckets. Each refresh folds only the new source files into
these states (see ``flows.KeyedFlow``) and finalises the view from them; the
result equals a full recomputation over all rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import tables
from tierline.functions.scalar import exact, not_finite
from tierline.operators.expectations import apply_expectations, observation_report
from tierline.plans.sales import SALES_EXPECTATIONS
from tierline.streaming.flows import KeyedFlow

_REDUCE = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


class PartialsFlow(KeyedFlow):
    """State: one row per group with partial aggregates. ``partials`` maps
    an output name to (op, column name or Column), op in count | sum | min |
    max; counts merge by summing. Rows that ``only`` (a condition) refuses
    are not counted."""

    def __init__(self, root: str, target: str, keys, partials: dict,
                 buckets: int | None = None, bucket_by=None, only=None):
        super().__init__(root, target, list(keys), buckets, bucket_by)
        self.partials, self.only = partials, only

    def reduce(self, rows: DataFrame) -> DataFrame:
        def column(c):
            if isinstance(c, str):
                return F.lit(1) if c == "*" else F.col(c)
            return c
        aggs = [_REDUCE[op](column(col)).alias(name) for name, (op, col) in self.partials.items()]
        if self.only is not None:
            rows = rows.filter(self.only)
        return rows.groupBy(*self.keys).agg(*aggs)

    def combine(self, state: DataFrame, reduced: DataFrame) -> DataFrame:
        aggs = [_MERGE[op](F.col(name)).alias(name) for name, (op, _) in self.partials.items()]
        return state.unionByName(reduced).groupBy(*self.keys).agg(*aggs)


class DistinctFlow(KeyedFlow):
    """State: the distinct (keys) tuples seen so far; rows whose ``value``
    columns are null are not counted (as COUNT(DISTINCT) ignores nulls)."""

    def __init__(self, root: str, target: str, keys, values, buckets: int | None = None):
        super().__init__(root, target, list(keys), buckets)
        self.values = [values] if isinstance(values, str) else list(values)

    def reduce(self, rows: DataFrame) -> DataFrame:
        ok = F.lit(True)
        for v in self.values:
            ok = ok & F.col(v).isNotNull()
        return rows.select(*self.keys).filter(ok).dropDuplicates(self.keys)

    def combine(self, state: DataFrame, reduced: DataFrame) -> DataFrame:
        return state.unionByName(reduced).dropDuplicates(self.keys)


class IncrementalSalesStats:
    """``sales_stats`` maintained incrementally from the
    ``sales_transactions`` streaming table: partials per product plus the
    (product, customer) and (product, franchise) sets."""

    def __init__(self, root: str, buckets: int | None = None):
        self.root = root
        self.partials = PartialsFlow(root, "sales_partials", ["product"], {
            "txn_count": ("count", "*"), "units_sold": ("sum", "quantity"),
            "_price_sum": ("sum", exact("totalPrice")), "_price_n": ("count", "totalPrice"),
            "_price_odd": ("count", F.when(not_finite("totalPrice"), 1))},
            buckets)
        self.customers = DistinctFlow(root, "sales_customers", ["product", "customerID"],
                                      "customerID", buckets)
        self.franchises = DistinctFlow(root, "sales_franchises", ["product", "franchiseID"],
                                       "franchiseID", buckets)

    def view(self, spark: SparkSession, late: DataFrame | None = None) -> DataFrame:
        """The view over the states and, beside them, ``late`` transactions
        (stored waiting, complete by now)."""
        def state(flow: KeyedFlow) -> DataFrame:
            held = flow.read(spark)
            return held if late is None else flow.combine(held, flow.reduce(late))

        p = state(self.partials)
        c = (state(self.customers).groupBy(F.col("product").alias("_pc"))
                 .agg(F.count(F.lit(1)).alias("unique_customers")))
        f = (state(self.franchises).groupBy(F.col("product").alias("_pf"))
                 .agg(F.count(F.lit(1)).alias("franchises_selling")))
        j = (p.join(c, p.product.eqNullSafe(c._pc), "left")
              .join(f, p.product.eqNullSafe(f._pf), "left"))
        def finite(c):                      # a NaN or infinity makes the figure NaN
            return F.when(F.col("_price_odd") > 0, F.lit(float("nan"))).otherwise(c.cast("double"))

        return j.select(
            "product", "txn_count", "units_sold",
            finite(F.round("_price_sum", 2)).alias("gross_revenue"),
            finite(F.round(F.col("_price_sum") / F.col("_price_n"), 2)).alias("avg_txn_value"),
            F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
            F.coalesce("franchises_selling", F.lit(0)).alias("franchises_selling"))

    def refresh(self, spark: SparkSession, source_path: str, late: DataFrame | None = None) -> int:
        """Folds the new rows into the states, then publishes the gated view
        and its expectation report; returns the view version."""
        # the three states are independent: their jobs run concurrently
        with ThreadPoolExecutor(max_workers=3) as pool:
            for f in [pool.submit(flow.run, spark, source_path)
                      for flow in (self.partials, self.customers, self.franchises)]:
                f.result()
        gated, obs = apply_expectations(self.view(spark, late), SALES_EXPECTATIONS, "sales_stats")
        v = tables.publish(gated, self.root, "sales_stats")
        tables.publish(observation_report(spark, obs, SALES_EXPECTATIONS, "sales_stats"),
                       self.root, "sales_stats_expectations")
        return v
