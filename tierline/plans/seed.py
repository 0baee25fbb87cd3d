"""Seeding fraud markers: a percentage of the distinct booking ids, each with
flag, reason, flagged_at and confidence derived from a hash of the id, written
as JSON lines into a landing folder that the fraud pipeline streams from.

Selection is a hash threshold on the key (same keys on any cluster layout);
``method='bernoulli'`` is the seeded row sample. The derived columns use
Spark's murmur3 ``abs(hash(booking_id))`` (``digest='murmur3'``) or a plain
arithmetic hash that SQL engines can reproduce (``digest='portable'``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.scalar import (
    flagged_at, fraud_confidence, fraud_reason, key_hash, portable_key_hash,
)
from tierline.operators.sampling import check_percent, stable_sample
from tierline.plans.fraud import FLAG_SCHEMA

DEFAULT_AS_OF = dt.datetime(2026, 5, 17, 13, 34, 0)


def check_files(n_files) -> int:
    try:
        n = int(n_files)
    except (TypeError, ValueError) as e:
        raise ValueError(f"number of files must be an integer, got {n_files!r}") from e
    if n < 1:
        raise ValueError(f"number of files must be at least 1, got {n}")
    return n


def _as_of_col(as_of) -> Column:
    if as_of is None:
        # now, as UTC wall-clock time: the text ends in a literal 'Z'
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, Column):
        return as_of
    return F.to_timestamp_ntz(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")))


def fraud_markers(booking_updates: DataFrame, pct: float = 3.0, method: str = "xxhash64",
                  digest: str = "murmur3", as_of=DEFAULT_AS_OF, seed: int = 42) -> DataFrame:
    """booking_id, flag, reason, flagged_at, confidence for ``pct`` % of the
    distinct booking ids (partial+final distinct, then a filter)."""
    check_percent(pct)
    ids = booking_updates.select("booking_id").distinct()
    picked = stable_sample(ids, "booking_id", pct, method=method, seed=seed)
    if digest == "murmur3":
        h = key_hash("booking_id")
    elif digest == "portable":
        h = portable_key_hash("booking_id")
    else:
        raise ValueError(f"digest must be 'murmur3' or 'portable', got {digest!r}")
    return picked.select(
        F.col("booking_id").cast("bigint").alias("booking_id"),
        F.lit("fraud").alias("flag"),
        fraud_reason(h).alias("reason"),
        flagged_at(h, _as_of_col(as_of)).alias("flagged_at"),
        fraud_confidence(h).alias("confidence"))


def write_markers(markers: DataFrame, path: str, n_files: int = 5) -> None:
    """JSON lines in at most ``n_files`` files (empty partitions write none).
    Replaces what the folder held. ``n_files`` is also the write parallelism:
    size it to the number of markers (a few hundred MB per file)."""
    markers.repartition(check_files(n_files)).write.mode("overwrite").json(path)


def read_markers(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Batch read of the landing folder; malformed lines keep their text in
    ``_corrupt_record`` (explicit schema) instead of failing the read."""
    r = spark.read.option("columnNameOfCorruptRecord", "_corrupt_record")
    if not infer:
        r = r.schema(FLAG_SCHEMA + ", _corrupt_record string")
    return r.json(path)


def seed_fraud_markers(spark: SparkSession, booking_updates: DataFrame, path: str,
                       pct: float = 3.0, n_files: int = 5, **kw) -> DataFrame:
    """Validate, select, write, and return the markers read back from disk."""
    check_percent(pct)
    check_files(n_files)
    write_markers(fraud_markers(booking_updates, pct, **kw), path, n_files)
    return read_markers(spark, path).drop("_corrupt_record")
