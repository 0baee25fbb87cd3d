"""Exact deduplication with a heavy-hitter split (operator 9), DataFrame
functions only.

Plan. One pass over the texts writes ``(doc_id, row, digest)`` to the shared
folder; every later step reads only that narrow table.

1. Misra-Gries: a mergeable frequent-items summary (``approx_top_k_*``, the
   Misra-Gries summary of the DataSketches library) is built per input
   partition, merged in two levels, and names candidate digests. It holds at
   most ``tracked`` digests whatever the input size, so every digest with more
   than about ``7 / tracked`` of all rows is named.
2. Verification: candidates are counted exactly (map-side filter and partial
   aggregate); those holding at least ``1 / tracked`` of the rows are the
   winners, at most ``tracked`` rows by construction, which bounds the
   broadcast.
3. Rows of a winner get their group's answer from the broadcast in the map
   tasks and never enter a shuffle. The rest is grouped by an ordinary shuffle
   on the digest, where no group is hot any more.

Defined results: a null text counts as empty, so all null and empty texts are
one group; a null ``doc_id`` is smaller than any other; of rows that tie on the
largest ``doc_id`` exactly one stays (they are the same document); an empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import lower_ascii, stored

TRACKED = 2048          # digests the summary holds; also the broadcast's bound
MERGE_GROUPS = 64       # first merge level of the summaries


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest): SHA-256 of the normalised text of every row;
    ``row`` is unique, it tells repeated rows apart once written."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.monotonically_increasing_id().alias("row"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def frequent_candidates(d: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Digests (hex) the Misra-Gries summary names, at most ``tracked``."""
    part = F.spark_partition_id()
    by_part = (d.select(part.alias("_p"), F.hex("digest").alias("item"))
               .groupBy("_p").agg(F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("s")))
    level1 = (by_part.groupBy((F.col("_p") % MERGE_GROUPS).alias("_g"))
              .agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s")))
    # a constant key: unlike a global aggregate it makes no buffer for empty partitions
    top = level1.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    return (top.select(F.explode(F.expr(f"approx_top_k_estimate(s, {tracked})")).alias("e"))
            .select(F.unhex("e.item").alias("digest")))


def winners(d: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Verified frequent digests with their exact group: at most ``tracked``
    rows, held by the driver as a local table."""
    spark = d.sparkSession
    n = d.count()
    schema = "digest binary, keep struct<doc_id: bigint, row: bigint>, group_size bigint"
    if n == 0:
        return spark.createDataFrame([], schema)
    names = [r[0] for r in frequent_candidates(d, tracked).limit(tracked).collect()]
    cand = spark.createDataFrame([(bytes(x),) for x in names], "digest binary")
    rows = (d.join(F.broadcast(cand), "digest", "left_semi").groupBy("digest")
            .agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                 F.count(F.lit(1)).alias("group_size"))
            .filter(F.col("group_size") * tracked >= n).collect())
    return spark.createDataFrame(rows, schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tracked: int = TRACKED) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. The row with the largest id of each group of equal
    normalised texts stays."""
    d = stored(digests(docs, id_col, text_col), "digests")
    heavy = winners(d, tracked)
    tagged = d.join(F.broadcast(heavy), "digest", "left")
    hot = tagged.filter(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    cold = (tagged.filter(F.col("group_size").isNull())
            .select("digest", "doc_id", "row",
                    F.max(F.struct("doc_id", "row")).over(group).alias("keep"),
                    F.count(F.lit(1)).over(group).alias("group_size")))
    return hot.unionByName(cold).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
