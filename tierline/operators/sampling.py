"""Seeded, partitioning-independent sampling of keys.

``DataFrame.sample(fraction, seed)`` picks different rows when the number of
partitions changes. A threshold on a hash of the key picks the same keys on any
cluster layout, and each key independently with probability pct/100.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.scalar import SELECT_PRIME, portable_select_hash

METHODS = ("xxhash64", "portable", "bernoulli")
STEPS = 1 << 40         # of the xxhash64 threshold


def check_percent(pct: float) -> float:
    try:
        pct = float(pct)
    except (TypeError, ValueError) as e:
        raise ValueError(f"percentage must be a number, got {pct!r}") from e
    if not 0.0 <= pct <= 100.0:
        raise ValueError(f"percentage must be between 0 and 100, got {pct}")
    return pct


def sample_condition(key: str, pct: float, method: str = "xxhash64", seed: int = 42) -> Column:
    """Keep condition: the key's hash is below pct / 100 of the hash range.
    The hash is not the one that derived columns use."""
    share = check_percent(pct) / 100.0
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(STEPS)) < F.lit(
            math.ceil(share * STEPS))
    if method == "portable":
        return portable_select_hash(key) < F.lit(math.ceil(share * SELECT_PRIME))
    raise ValueError(f"method must be one of {METHODS}, got {method!r}")


def stable_sample(df: DataFrame, key: str, pct: float, method: str = "xxhash64",
                  seed: int = 42) -> DataFrame:
    """Rows whose key falls under the threshold; a filter, no shuffle.
    ``method='bernoulli'`` is Spark's seeded row sample (layout dependent)."""
    if method == "bernoulli":
        return df.sample(withReplacement=False, fraction=check_percent(pct) / 100.0, seed=seed)
    return df.filter(sample_condition(key, pct, method, seed))
