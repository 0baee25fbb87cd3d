"""Row removal: delete by predicate and duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows that a SQL ``DELETE ... WHERE predicate`` keeps: the predicate is
    not TRUE (FALSE or NULL). A filter; it is pushed into the parquet scan."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(p, F.lit(False)))


def dedupe(df: DataFrame, keys, event_time: str | None = None,
           delay: str | None = None) -> DataFrame:
    """Removes rows repeated by at-least-once delivery, keeping one per key.

    Batch: a partial+final aggregate on the keys. Streaming without
    ``event_time``: state per key forever (RocksDB state store at scale).
    Streaming with ``event_time``/``delay``: state dropped once the watermark
    passes, duplicates arriving within ``delay`` of each other are removed."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if event_time is None:
        return df.dropDuplicates(keys)
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return df.withWatermark(event_time, delay or "1 hour").dropDuplicatesWithinWatermark(keys)
