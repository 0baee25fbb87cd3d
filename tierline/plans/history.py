"""History (SCD type 2) of a keyed feed and as-of reads of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.operators.cdc import as_of, scd2


def events_history(events: DataFrame) -> DataFrame:
    """Every event as a version of its user's row, ordered by event_id."""
    return scd2(events, ["user_id"], "event_id")


def midpoint(events: DataFrame) -> Column:
    """Half of the largest event_id, as a scalar subquery over the table."""
    return events.select(F.expr("max(event_id) div 2")).scalar()


def events_as_of(events: DataFrame, at=None) -> DataFrame:
    """Each user's row as of sequence ``at`` (default: the table midpoint)."""
    return as_of(events_history(events), midpoint(events) if at is None else at)
