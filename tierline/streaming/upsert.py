"""Incremental keyed upsert (AUTO CDC ... STORED AS SCD TYPE 1) into a Parquet
target, without MERGE: a ``KeyedFlow`` whose state is the current row per key.

Rows with a null key or sequence component are quarantined (kept in the
version's ``quarantine/``), never applied; they are counted while the merge
runs, and only scanned for again when there are any. Late rows (lower
sequence) never win, ties follow the SCD1 rule, and any split of the feed
into runs gives the same target as one batch over all of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.operators.cdc import END_AT, START_AT, scd1, scd1_merge, scd2, valid_condition, winner
from tierline.streaming.flows import KeyedFlow


@dataclass
class Scd1Flow(KeyedFlow):
    sequence_by: object = None

    def __init__(self, root: str, target: str, keys, sequence_by, buckets: int | None = None):
        super().__init__(root, target, list(keys), buckets)
        self.sequence_by = sequence_by

    def prepare(self, changes: DataFrame):
        ok = valid_condition(self.keys, self.sequence_by)
        obs = Observation(f"scd1_{self.target}")
        observed = changes.observe(obs, F.count_if(~ok).alias("invalid"))
        return observed, changes.filter(~ok), obs

    def reduce(self, rows: DataFrame) -> DataFrame:
        return scd1(rows, self.keys, self.sequence_by)

    def combine(self, state: DataFrame, reduced: DataFrame) -> DataFrame:
        return scd1_merge(state, reduced, self.keys, self.sequence_by)


@dataclass
class Scd2Flow(KeyedFlow):
    """Incremental history (``STORED AS SCD TYPE 2``): every accepted
    (key, sequence) is a version with __START_AT / __END_AT.

    A merge writes the new versions and those right before them, whose end
    moves; all others stay as they are. Who stands next to a new sequence is
    told from keys and sequences alone, of the touched keys only (``scd2``, so
    a hot key is cut into slices of its sequence); payloads of the versions
    whose end moves are then picked from the state in their buckets. The state
    is bucketed on (keys, sequence), so the history of a hot key spreads over
    all buckets. Inserting versions only ever brings an end forward, so copies
    of a version in several deltas combine to the earliest end, in any order."""
    sequence_by: str = None

    def __init__(self, root: str, target: str, keys, sequence_by: str,
                 buckets: int | None = None):
        super().__init__(root, target, list(keys), buckets, [*keys, sequence_by])
        self.sequence_by = sequence_by

    def prepare(self, changes: DataFrame):
        ok = valid_condition(self.keys, self.sequence_by)
        obs = Observation(f"scd2_{self.target}")
        observed = changes.observe(obs, F.count_if(~ok).alias("invalid"))
        return observed, changes.filter(~ok), obs

    def reduce(self, rows: DataFrame) -> DataFrame:
        # one row per (key, sequence), ties by the SCD1 rule
        return scd1(rows, self.keys + [self.sequence_by], self.sequence_by)

    def initial(self, reduced: DataFrame) -> DataFrame:
        return scd2(reduced, self.keys, self.sequence_by)

    def changes(self, spark: SparkSession, reduced: DataFrame) -> DataFrame:
        version = [*self.keys, self.sequence_by]
        state = self.read(spark)
        touched = reduced.select(*self.keys).distinct()
        known = (state.select(*version, F.col(END_AT).alias("_was"), F.lit(False).alias("_new"))
                 .join(touched, self.keys, "left_semi"))
        points = known.unionByName(reduced.select(
            *version, F.lit(None).cast(known.schema["_was"].dataType).alias("_was"),
            F.lit(True).alias("_new")))
        # a sequence that comes again is one point, and new
        points = points.groupBy(*version).agg(F.max("_new").alias("_new"), F.max("_was").alias("_was"))
        placed = scd2(points, self.keys, self.sequence_by)
        fresh = placed.filter("_new").select(*version, START_AT, END_AT)
        moved = (placed.filter(~F.col("_new") & ~F.col("_was").eqNullSafe(F.col(END_AT)))
                 .select(*version, F.col(END_AT).alias("_end")))
        new = reduced.join(fresh, version)
        old = (state.join(moved, version)
               .withColumn(END_AT, F.col("_end")).drop("_end").select(*state.columns))
        return (old.unionByName(new, allowMissingColumns=True)
                .repartition(self.resolve_buckets(spark), *version))

    def combine(self, state: DataFrame, reduced: DataFrame) -> DataFrame:
        both = state.unionByName(reduced, allowMissingColumns=True)
        version = [*self.keys, self.sequence_by]
        payload = [c for c in both.columns if c not in (START_AT, END_AT)]
        won = winner(both.select(*payload), version, [self.sequence_by])
        ends = F.min(F.struct(F.col(END_AT).isNull().alias("open"), F.col(END_AT).alias("end"))).alias("_e")
        one = both.groupBy(*version).agg(won.alias("_w"), ends)
        return one.select(*[F.col(c) if c in version else F.col(f"_w.{c}").alias(c) for c in payload],
                          F.col(self.sequence_by).alias(START_AT), F.col("_e.end").alias(END_AT))
