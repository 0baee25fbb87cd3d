"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import work_root

# A word: a run of anything but ASCII white space (Java and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, every other character kept."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (a null id counts as
    the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back:
    cuts the lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{work_root(spark, name)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_fold: int,
                    rows: dict[int, int], id_col: str, text_col: str) -> tuple[DataFrame, dict[int, int]]:
    """(text, y, h) of a hash sample of the labelled rows, about ``rows[y]`` of
    class ``y``, and the number of labels per class. Labels of ``held_fold``
    are left out; an id that is labelled both ways counts as 1, and of rows that
    share an id the smallest text is taken; ``h`` is a hash of the id. The sample's size is fixed by
    ``rows``, so its ids and labels can be broadcast and no text is shuffled."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull()
                     & (id_fold(F.col("id"), folds) != held_fold))
             .groupBy("id").agg(F.max("y").alias("y")))
    have = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    h = F.xxhash64("id", F.lit("fit"))
    part = F.pmod(h, F.lit(1 << 20))
    wanted = F.lit(False)
    for y, n in have.items():
        wanted = wanted | ((F.col("y") == y) & (part < int(min(1.0, rows[y] / n) * (1 << 20))))
    picked = known.filter(wanted).withColumn("h", h)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return (docs.select(F.col(id_col).alias("id"), text).join(F.broadcast(picked), "id")
            .groupBy("id", "y", "h").agg(F.min("text").alias("text")).select("text", "y", "h")), have
