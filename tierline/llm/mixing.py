"""Mixing sources to target weights by pivotal dependent rounding (operator 1).

Targets: source sizes are words; a source's target is its weight's share of
the mix, at most ``max_repeat`` times its size, the excess going to the others
by weight until none is above (water-filling over the source table).

Rounding: each document of a source should be taken ``target / size`` times, a
whole part and a fraction. Fractions are rounded by the pivotal method: two
fractional documents exchange mass at random, one gaining the words that the
other loses, until one of the two is integral; the other goes on to the next
partner. The exchange keeps the expected number of copies of both and their
words together, so a group ends with at most one fractional document and its
words unchanged but for that one.

Scale: documents are dealt by hash into groups of about ``GROUP`` rows per
source (a hot source is just more groups), each group reduced in one task; the
left-over documents are the input of the next level, a tree of
``log_GROUP(rows)`` levels, until one per source is left, which is rounded by
its own random number. Only ids and sizes move; texts are read once. Random
numbers come from hashes of the data and a seed, so reruns and retried tasks
agree.

Defined results: a null source is a source of its own (last in order); null
and empty texts have size 0 and take 0 words (in ``mix`` they are copied as
often as the other documents of the source on average); a source of size 0 has
target 0; repeated rows are independent documents; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0
GROUP = 1024
SEED = 1
LARGE = 1000            # sources with more than a LARGE-th of all rows are joined in SALTS parts
SALTS = 64


def water_fill(sizes: list[float], weights: list[float], max_repeat: float) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``max_repeat``
    times its size: ``source_targets`` on lists."""
    targets = [0.0] * len(sizes)
    open_, rest = set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if rest * weights[i] / total > max_repeat * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = rest * weights[i] / total
            break
        for i in full:
            targets[i] = max_repeat * sizes[i]
        rest -= sum(targets[i] for i in full)
        open_ -= set(full)
    return targets


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``source_no``, gapless from 0 in code-point order, null
    last: sorted by range, numbered per range behind the counts of the ranges
    before it (one row per partition)."""
    order = [F.col("source").isNull(), F.col("source")]
    cut = stored(sources.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return (cut.withColumn("place", place).join(F.broadcast(starts), "part")
            .withColumn("source_no", F.col("start") + F.col("place") - 1)
            .drop("part", "place", "start"))


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_no, rows, weighed, source_size, target) from (source,
    size) rows: numbers of rows and of rows with words, words, target. Sources
    come in code-point order, null last, and weigh ``weights`` in turn; targets
    share all words by weight, none above ``max_repeat`` times its size
    (water-filling).

    Each round marks the sources that the present level fills and raises the
    level for the others, by one aggregate over the stored source table that
    returns a row per weight. A filled source stays filled, so rounds end when
    their number no longer changes. Sums are of whole numbers, so exact."""
    plan = stored(ranked(sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("size") > 0).alias("weighed"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))), "sources")
    plan = plan.withColumn("kind", F.pmod("source_no", F.lit(len(weights))).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    cap = F.lit(float(max_repeat)) * F.col("source_size")
    words = float(plan.agg(F.sum("source_size")).first()[0] or 0)
    rest, total, filled = words, None, -1
    full = F.lit(False)
    while True:
        rows = plan.groupBy("kind").agg(
            F.count_if(~full).alias("open"), F.count_if(full).alias("filled"),
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("size")).collect()
        rest = words - max_repeat * sum(r["size"] for r in rows)
        total = sum(float(weights[r["kind"]]) * r["open"] for r in sorted(rows))
        now = sum(r["filled"] for r in rows)
        if now == filled or total <= 0:
            break
        filled = now
        full = F.lit(rest) * weight / F.lit(total) > cap
    share = F.lit(rest) * weight / F.lit(total or 1.0)
    return plan.select("source", "source_no", "rows", "weighed", "source_size",
                       F.when(full, cap).otherwise(share).alias("target"))


def pivot(size: np.ndarray, prob: np.ndarray, rnd: np.ndarray) -> np.ndarray:
    """Pivotal rounding of one group: probabilities after all exchanges; at
    most one stays fractional. ``size * prob`` sums to what it was."""
    x = prob.astype(float).copy()
    hand = -1
    for i in range(len(x)):
        if not 0.0 < x[i] < 1.0:
            continue
        if hand < 0:
            hand = i
            continue
        a, b, wa, wb = x[hand], x[i], float(size[hand]), float(size[i])
        # words that can move from b to a, and from a to b
        up, down = min((1 - a) * wa, b * wb), min(a * wa, (1 - b) * wb)
        move = up if rnd[i] * (up + down) < down else -down
        a, b = a + move / wa, b - move / wb
        x[hand] = 0.0 if a < 1e-9 else 1.0 if a > 1 - 1e-9 else a
        x[i] = 0.0 if b < 1e-9 else 1.0 if b > 1 - 1e-9 else b
        if 0.0 < x[i] < 1.0:
            hand = i
        elif not 0.0 < x[hand] < 1.0:
            hand = -1
    return x


def _uniform(*cols: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*cols), 12) + F.lit(0.5)) / F.lit(float(1 << 52))


def _round_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (source_no, grp, row key); a group may span batches.
    Of a batch's last group only the document that is still fractional waits
    for the next batch."""
    hand: pd.DataFrame | None = None
    for pdf in batches:
        if hand is not None:
            pdf = pd.concat([hand, pdf], ignore_index=True)
            hand = None
        if not len(pdf):
            continue
        source, grp = pdf["source_no"].to_numpy(), pdf["grp"].to_numpy()
        cuts = np.flatnonzero((source[1:] != source[:-1]) | (grp[1:] != grp[:-1])) + 1
        edges = [0, *cuts.tolist(), len(pdf)]
        size, prob, rnd = (pdf[c].to_numpy() for c in ("size", "prob", "rnd"))
        new = np.concatenate([pivot(size[a:b], prob[a:b], rnd[a:b])
                              for a, b in zip(edges[:-1], edges[1:], strict=True)])
        pdf = pdf.assign(prob=new)
        last = np.arange(len(pdf)) >= edges[-2]
        waits = last & (new > 0) & (new < 1)
        if waits.any():
            hand = pdf[waits]
        yield pdf.loc[~waits, ["row", "prob"]]
    if hand is not None:
        yield hand[["row", "prob"]]


def copies(docs: DataFrame, keep: list[Column], weights=WEIGHTS, max_repeat: float = MAX_REPEAT,
           seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """``keep`` columns with size, source_size, target and ``copies`` of every
    row. ``keep`` is stored next to the sizes, so pass only what is needed."""
    spark = docs.sparkSession
    fields = [f"k{i}" for i in range(len(keep))]
    base = stored(docs.select(
        F.struct(*[c.alias(f) for c, f in zip(keep, fields, strict=True)]).alias("keep"),
        F.col(source_col).cast("string").alias("source"),
        F.monotonically_increasing_id().alias("row"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col))).alias("h")), "sizes")
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_src")
    plan = stored(source_targets(base.select("source", "size"), weights, max_repeat)
                  .select(key, "source_no", "rows", "weighed", "source_size", "target"), "plan")
    every = plan.agg(F.sum("rows")).first()[0] or 0
    large = F.col("rows") > F.lit(every / LARGE)
    # fewer than LARGE rows; however many sources there are, none meets in one task
    hot = F.broadcast(plan.filter(large).select("_src", F.lit(True).alias("_hot")))
    parts = F.when(large, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(F.col("_hot"), F.pmod("row", F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    sized = (base.withColumn("_src", key).join(hot, "_src", "left").withColumn("_salt", salt)
             .drop("_hot").join(plan.withColumn("_salt", F.explode(parts)), ["_src", "_salt"])
             .withColumn("groups", F.ceil(F.col("weighed") / GROUP))
             .withColumn("each", F.when(F.col("source_size") > 0,
                                        F.least(F.col("target") / F.col("source_size"),
                                                F.lit(max_repeat))).otherwise(F.lit(1.0)))
             .withColumn("whole", F.floor("each"))
             .withColumn("frac", F.col("each") - F.floor("each")))
    exact = F.col("size") > 0
    todo = sized.filter(exact & (F.col("frac") > 0)).select(
        "row", "source_no", "groups", "size", "h", F.col("frac").alias("prob"))
    settled, level = None, 0
    # a group leaves one document at most, so the next level's groups are known
    groups = todo.agg(F.max("groups")).first()[0] or 0
    while groups > 0:
        dealt = (todo.withColumn("grp", F.pmod(F.xxhash64("h", F.lit(level)), F.col("groups")))
                 .withColumn("rnd", _uniform(F.col("h"), F.lit(level), F.lit("x")))
                 .repartition("source_no", "grp")
                 # neighbours of like size exchange mass: totals stay close for any subset
                 .sortWithinPartitions("source_no", "grp", "size", "h", "row"))
        moved = dealt.select("source_no", "grp", "row", "size", "prob", "rnd").mapInPandas(
            _round_groups, "row long, prob double")
        moved = stored(moved, f"level{level}")
        done = moved.filter((F.col("prob") <= 0) | (F.col("prob") >= 1))
        settled = done if settled is None else settled.unionByName(done)
        left = moved.filter((F.col("prob") > 0) & (F.col("prob") < 1))
        todo = stored(left.join(todo.drop("prob"), "row")
                      .withColumn("groups", F.ceil(F.col("groups") / GROUP)), f"left{level}")
        level += 1
        groups = 0 if groups == 1 else -(-groups // GROUP)
    last = todo.select("row", F.when(_uniform(F.col("h"), F.lit("last")) < F.col("prob"), 1.0)
                       .otherwise(0.0).alias("prob"))
    rounded = (last if settled is None else settled.unionByName(last)) \
        .withColumnRenamed("prob", "extra")
    # one decision per row: as large a table as the documents, so never broadcast
    out = sized.join(rounded.hint("merge"), "row", "left")
    loose = F.when(_uniform(F.col("h"), F.lit("empty")) < F.col("frac"), 1.0).otherwise(0.0)
    n_copies = (F.col("whole") + F.coalesce("extra", F.when(~exact, loose), F.lit(0.0))).cast("long")
    return out.select(*[F.col(f"keep.{f}").alias(f) for f in fields], "size", "source_size",
                      "target", n_copies.alias("copies"), "row")


def mixture(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row."""
    c = copies(docs, [F.col(kw.get("id_col", "doc_id"))], **kw)
    return c.select(F.col("k0").alias("doc_id"), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents: every row as often as it is taken, columns as in
    the input."""
    cols = list(docs.columns)
    c = copies(docs, [F.struct(*[F.col(f"`{x}`") for x in cols])], **kw).filter("copies > 0")
    return c.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))) \
        .select(*[F.col(f"k0.`{x}`").alias(x) for x in cols])
