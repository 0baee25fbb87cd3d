"""Weighted rendezvous hashing of record keys over shards (operator 3).

The shard of a record is the one with the highest score
``-weight / ln(u(key, shard))``, ``u`` a hash of key and shard in (0, 1): a
function of the key and the shard list alone. A shard's share of the keys is
proportional to its weight, and one more shard only takes records into itself,
since every other pair's score stays what it was.

Slots number the records of a shard without gaps. Records are cut into
``(shard, bucket)`` cells by hash, equal records are counted before the shuffle
(a record that repeats a million times moves as one row per task), cells are
numbered by a running sum, and the cells' offsets come from the small table of
cell totals. So no task sees a whole shard, however few shards there are.

Defined results: a null key is a key of its own (the empty text); a null text
has no bytes, so size 8 and crc 0; repeated rows get a slot each. Columns other
than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import shuffle_parts, stored

RECORD_OVERHEAD = 8
COPY_CHUNK = 4096       # equal records expanded per row in the last step


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number of ``key`` among ``len(weights)`` weighted shards."""
    def score(i: int, w: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 12)     # 52 bits
        return F.lit(-float(w)) / F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52)))
    if len(weights) == 1:
        return F.lit(0)
    best = F.greatest(*[F.struct(score(i, w).alias("score"), F.lit(-i).alias("neg"))
                        for i, w in enumerate(weights)])       # a tie goes to the lower shard
    return (-best.getField("neg")).cast("int")


def shard_records(docs: DataFrame, weights: list[float], grown_weight: float = 1.0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` of every row;
    ``grown_shard`` is the shard once one more of ``grown_weight`` exists."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rec = docs.select(F.col(id_col).alias("doc_id"),
                      (F.octet_length(raw) + RECORD_OVERHEAD).cast("long").alias("size"),
                      F.crc32(raw).alias("text_crc32"),
                      rendezvous(key, weights).alias("shard"),
                      rendezvous(key, [*weights, grown_weight]).alias("grown_shard"))
    buckets = max(1, -(-4 * shuffle_parts(spark) // max(1, len(weights))))
    # a record is (doc_id, size, crc); its shards follow from doc_id
    counted = stored(rec.groupBy("doc_id", "size", "text_crc32", "shard", "grown_shard")
                     .agg(F.count(F.lit(1)).alias("copies"))
                     .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"),
                                                  F.lit(buckets)).cast("int")), "records")
    cells = counted.groupBy("shard", "bucket").agg(F.sum("copies").alias("cell_rows"))
    # shards x buckets rows: numbers fixed by the cluster's partition count
    offset = F.sum("cell_rows").over(Window.partitionBy("shard").orderBy("bucket")
                                     .rowsBetween(Window.unboundedPreceding, -1))
    offsets = cells.select("shard", "bucket", F.coalesce(offset, F.lit(0)).alias("cell_start"))
    order = ["doc_id", "size", "text_crc32"]
    before = F.sum("copies").over(Window.partitionBy("shard", "bucket").orderBy(*order)
                                  .rowsBetween(Window.unboundedPreceding, -1))
    placed = (counted.withColumn("before", F.coalesce(before, F.lit(0)))
              .join(offsets, ["shard", "bucket"])
              .withColumn("first", F.col("cell_start") + F.col("before")))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"),
                                 F.expr(f"(copies - 1) div {COPY_CHUNK}")))
    last = F.least(F.col("copies"), (F.col("chunk") + 1) * COPY_CHUNK) - 1
    return (placed.withColumn("chunk", chunk)
            .withColumn("copy", F.explode(F.sequence(F.col("chunk") * COPY_CHUNK, last)))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + F.col("copy")).alias("slot"), "grown_shard"))
