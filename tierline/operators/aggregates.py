"""Mergeable partial aggregates for incremental view maintenance.

A view over count / sum / avg / min / max is kept as partials per group
(count, exact decimal sum, min, max). New data is reduced to partials of its own, merged by
another partial+final aggregate, and the view is finalised from the partials.
Distinct counts are not mergeable this way and need a full refresh (or the set
of (group, value) pairs kept as a table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.scalar import exact


def partials(df: DataFrame, keys, measure: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(
        F.count(F.col(measure)).alias("_n"), F.count(F.lit(1)).alias("_rows"),
        F.sum(exact(measure)).alias("_sum"), F.min(measure).alias("_min"),
        F.max(measure).alias("_max"))


def merge_partials(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return a.unionByName(b).groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"), F.sum("_sum").alias("_sum"),
        F.min("_min").alias("_min"), F.max("_max").alias("_max"))


def finalize(p: DataFrame, keys, prefix: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return p.select(*keys,
                    F.col("_rows").alias(f"{prefix}_rows"),
                    F.round("_sum", 2).cast("double").alias(f"{prefix}_sum"),
                    F.round(F.col("_sum") / F.col("_n"), 2).cast("double").alias(f"{prefix}_avg"),
                    F.col("_min").alias(f"{prefix}_min"),
                    F.col("_max").alias(f"{prefix}_max"))
