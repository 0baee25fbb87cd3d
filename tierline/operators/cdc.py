"""Keyed change-data operators: SCD type 1 (current row per key) and SCD type 2
(every version with __START_AT / __END_AT), plus as-of reads of the history.

Ordering: highest sequence wins. Sequences may be one column or several
(compared left to right). Ties on the whole sequence go to the higher
xxhash64 of the payload, then to the payload columns themselves, so the winner
never depends on arrival order, batching or partitioning. Rows with a null key
or a null sequence component are never applied (see ``split_invalid``).

Scale: SCD1 is ``groupBy(keys).agg(max_by(row, order))`` - a partial aggregate
runs before the shuffle, so a key holding a third of all rows is reduced to one
row per input partition map-side. SCD2 needs the successor of every version: a
window per key, where a hot key (more than a quarter of a partition's share of
all rows) is cut into slices of its sequence first, so no task holds a hot key
whole; the last version of a slice takes its end from the next slice's head.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START_AT = "__START_AT"
END_AT = "__END_AT"

_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def valid_condition(keys: Sequence[str], sequence_by) -> Column:
    cond = F.lit(True)
    for c in list(keys) + _as_list(sequence_by):
        cond = cond & F.col(c).isNotNull()
    return cond


def split_invalid(df: DataFrame, keys, sequence_by) -> tuple[DataFrame, DataFrame]:
    """(rows that can be applied, quarantined rows with a null key or sequence)."""
    ok = valid_condition(_as_list(keys), sequence_by)
    return df.filter(ok), df.filter(~ok)


def _hashable(df: DataFrame, cols) -> list[str]:
    """Columns Spark can hash (hash expressions refuse maps)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [c for c in cols if "map<" not in types[c]]


def _order(df: DataFrame, keys, seq) -> Column:
    payload = [c for c in df.columns if c not in keys]
    hashed = _hashable(df, payload)
    parts = [F.col(c) for c in seq]
    parts.append((F.xxhash64(*[F.col(c) for c in hashed]) if hashed else F.lit(0)).alias("_tie"))
    types = {f.name: f.dataType for f in df.schema.fields}
    parts += [F.col(c) for c in payload if c not in seq and isinstance(types[c], _ORDERABLE)]
    return F.struct(*parts)


def winner(valid: DataFrame, keys: list[str], seq: list[str]) -> Column:
    """Aggregate holding the columns, other than the keys, of the row that wins
    its key: highest sequence, ties by the SCD1 rule."""
    payload = [c for c in valid.columns if c not in keys]
    types = {f.name: f.dataType for f in valid.schema.fields}
    order = _order(valid, keys, seq)
    if all(isinstance(types[c], _ORDERABLE) or c in seq for c in payload) and "_tie" not in payload:
        return F.max(order)                  # the order holds the whole row
    return F.max_by(F.struct(*[F.col(c) for c in payload]), order)


def _reduce(valid: DataFrame, keys: list[str], seq: list[str], columns) -> DataFrame:
    payload = [c for c in columns if c not in keys]
    if not payload:
        return valid.select(*keys).distinct()
    won = valid.groupBy(*keys).agg(winner(valid.select(*columns), keys, seq).alias("_w"))
    return won.select(*[F.col(k) if k in keys else F.col(f"_w.{k}").alias(k) for k in columns])


def scd1(df: DataFrame, keys, sequence_by) -> DataFrame:
    """Current row per key (batch). Same columns and column order as ``df``."""
    keys, seq = _as_list(keys), _as_list(sequence_by)
    return _reduce(df.filter(valid_condition(keys, seq)), keys, seq, df.columns)


def scd1_merge(snapshot: DataFrame, changes: DataFrame, keys, sequence_by) -> DataFrame:
    """One upsert step: reduce(snapshot ∪ changes). Because the reduction is
    associative and commutative, any batching of the changes gives the same
    target as one batch over all of them. The snapshot is valid by
    construction; only the changes are filtered, before the union, so a
    snapshot bucketed on the keys keeps its partitioning through the union
    and is not shuffled. A column new in the changes is added (null in older
    rows); one they lack is null in theirs."""
    keys, seq = _as_list(keys), _as_list(sequence_by)
    ch = changes.filter(valid_condition(keys, seq))
    both = snapshot.unionByName(ch, allowMissingColumns=True)
    return _reduce(both, keys, seq, both.columns)


SLICES = 64              # sequence slices of a hot key, about
HOT_ROWS = 20_000        # a key with fewer rows is never sliced


def _hot_slices(valid: DataFrame, keys: list[str], seq: str, partitions: int,
                hot_rows: int) -> DataFrame:
    """(keys, _bounds) of the hot keys: those with more rows than ``hot_rows``
    and than a quarter of a partition's share of the table, so at most
    ``4 * partitions`` keys. The bounds are a hash sample of the sequence."""
    total = valid.agg(F.count(F.lit(1))).scalar()
    limit = F.greatest(F.lit(hot_rows), total / (4 * partitions))
    hot = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    one_in = F.ceil(F.col("_n") / SLICES)
    return (valid.select(*keys, seq).join(F.broadcast(hot), keys)
            .filter(F.pmod(F.xxhash64(seq), one_in) == 0)
            .groupBy(*keys).agg(F.sort_array(F.collect_set(seq)).alias("_bounds")))


def scd2(df: DataFrame, keys, sequence_by: str, partitions: int | None = None,
         hot_rows: int = HOT_ROWS) -> DataFrame:
    """History: one row per accepted (key, sequence) with __START_AT = sequence
    and __END_AT = the key's next sequence (null for the current version).
    Rows sharing (key, sequence) collapse by the SCD1 tie rule.

    Rows that repeat a (key, sequence) collapse in a partial aggregate before
    they are shuffled, so such a pair may hold any share of the rows; the
    versions are then shuffled by (key, slice); a key that is not hot has one
    slice. Everything stays in the JVM, so any payload passes unchanged."""
    keys, seq = _as_list(keys), sequence_by
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valid = df.filter(valid_condition(keys, [seq]))
    cols = valid.columns
    single = _reduce(valid, [*keys, seq], [seq], cols)
    # at most 4 * partitions keys
    hot = F.broadcast(_hot_slices(valid, keys, seq, n, hot_rows))
    place = F.size(F.filter("_bounds", lambda b: b <= F.col(seq)))
    sliced = single.join(hot, keys, "left").withColumn(
        "_slice", F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(place))
    # the next slice's first sequence, for hot keys: at most that many slices
    heads = (sliced.filter(F.col("_bounds").isNotNull()).groupBy(*keys, "_slice")
             .agg(F.min(seq).alias("_head"))
             .select(*keys, "_slice", F.lead("_head").over(
                 Window.partitionBy(*keys).orderBy("_slice")).alias("_after")))
    run = Window.partitionBy(*keys, "_slice").orderBy(seq)
    versions = sliced.withColumn("_next", F.lead(seq).over(run))
    ended = versions.join(F.broadcast(heads), [*keys, "_slice"], "left")
    return ended.select(*cols, F.col(seq).alias(START_AT),
                        F.coalesce("_next", "_after").alias(END_AT))


def as_of(history: DataFrame, at) -> DataFrame:
    """Versions current at sequence ``at`` (a value or a Column): a filter only,
    no shuffle. Equals ``scd1`` over the rows with sequence <= at."""
    at_c = at if isinstance(at, Column) else F.lit(at)
    return (history.filter((F.col(START_AT) <= at_c)
                           & (F.col(END_AT).isNull() | (F.col(END_AT) > at_c)))
                   .drop(START_AT, END_AT))
