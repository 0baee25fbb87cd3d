"""Fraud analysis: CDC bookings, fraud flags and payments.

    booking_updates --SCD1--> bookings --left join flags--> bookings_with_fraud
    bookings_with_fraud --join payments, group by (party, method)--> gold

Grain of the gold view: one row per *payment* (a booking paid twice counts
twice, a booking without payment is absent), as in the workshop's SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.operators.cdc import scd1
from tierline.sources.testdata import BOOKING_SEQUENCE

FLAG_SCHEMA = ("booking_id bigint, flag string, reason string, flagged_at string, "
               "confidence double")


def bookings(booking_updates: DataFrame) -> DataFrame:
    """Current row per booking (AUTO CDC ... STORED AS SCD TYPE 1)."""
    return scd1(booking_updates, ["booking_id"], BOOKING_SEQUENCE)


HOT_FLAGS = 20_000       # a booking with fewer flags is joined like any other


def hot_bookings(flags: DataFrame, partitions: int, hot_rows: int = HOT_FLAGS,
                 counts: DataFrame | None = None) -> list[int]:
    """Bookings with more flags than ``hot_rows`` and than a quarter of a
    partition's share of all flags: at most ``4 * partitions`` ids. ``counts``
    (booking_id, _flags) saves counting the flags."""
    if counts is None:
        total = flags.count()
        if total <= hot_rows:
            return []
        counts = flags.groupBy("booking_id").agg(F.count(F.lit(1)).alias("_flags"))
    else:
        total = counts.agg(F.sum("_flags")).first()[0] or 0
    limit = max(hot_rows, total / (4 * partitions))
    hot = counts.filter((F.col("_flags") > limit) & F.col("booking_id").isNotNull())
    return sorted(r.booking_id for r in hot.select("booking_id").collect())


def bookings_with_fraud(bookings_df: DataFrame, flags: DataFrame,
                        hot: list[int] | None = None) -> DataFrame:
    """b.*, is_fraud (never null), fraud_confidence, fraud_reason. A booking
    with two flags appears twice, as the plain left join gives it.

    The flags of ``hot`` bookings (``hot_bookings``; none unless given) are
    not shuffled: those bookings, one current row each, are sent to them, so a
    booking that holds a third of all flags is joined where its flags are read."""
    f = flags.select(F.col("booking_id").alias("_fid"), "flag", "confidence", "reason")
    if not hot:
        return _flagged(bookings_df, bookings_df.join(f, bookings_df.booking_id == f._fid, "left"))
    ids = bookings_df.sparkSession.createDataFrame(
        [(i,) for i in hot], "_hot bigint")
    def split(df: DataFrame, key: str, how: str) -> DataFrame:
        return df.join(F.broadcast(ids), F.col(key) == ids["_hot"], how)

    cold_b, hot_b = (split(bookings_df, "booking_id", how) for how in ("left_anti", "left_semi"))
    cold_f, hot_f = (split(f, "_fid", how) for how in ("left_anti", "left_semi"))
    cold = cold_b.join(cold_f, F.col("booking_id") == F.col("_fid"), "left")
    spread = hot_f.join(F.broadcast(hot_b), F.col("booking_id") == F.col("_fid"))
    return _flagged(bookings_df, cold).unionByName(_flagged(bookings_df, spread))


def _flagged(bookings_df: DataFrame, joined: DataFrame) -> DataFrame:
    return joined.select(*bookings_df.columns,
                         F.when(F.col("flag") == "fraud", F.lit(True)).otherwise(F.lit(False))
                          .alias("is_fraud"),
                         F.col("confidence").alias("fraud_confidence"),
                         F.col("reason").alias("fraud_reason"))


def payment_counts(payments_df: DataFrame) -> DataFrame:
    """(booking_id, payment_method, _np): payments reduced per booking and
    method, partial aggregation map-side."""
    return payments_df.groupBy("booking_id", "payment_method").agg(F.count(F.lit(1)).alias("_np"))


def fraud_by_party_and_method(bwf: DataFrame, payments_df: DataFrame) -> DataFrame:
    """COUNT(*) of (booking, payment) pairs per (party_size, payment_method),
    fraud count and rate.

    Both sides are reduced before the join shuffle: payments to
    (booking_id, payment_method, n) and bookings to (booking_id, party_size,
    is_fraud, n) with partial aggregation map-side, so a booking holding a
    third of all payments crosses the network as a few rows. Pair counts are
    the products n_b * n_p, which is exactly the inner join's COUNT(*)."""
    return fraud_from_counts(bwf, payment_counts(payments_df))


def fraud_from_counts(bwf: DataFrame, pay_counts: DataFrame) -> DataFrame:
    """The gold view from bookings_with_fraud and payment counts
    (booking_id, payment_method, _np). With both inputs bucketed on
    booking_id the per-booking reduction and the join need no shuffle."""
    b = (bwf.groupBy("booking_id", F.col("guests_count").alias("party_size"), "is_fraud")
            .agg(F.count(F.lit(1)).alias("_nb")))
    pairs = (b.join(pay_counts.select("booking_id", "payment_method", "_np"), "booking_id")
              .select("party_size", "payment_method", "is_fraud",
                      (F.col("_nb") * F.col("_np")).alias("_n")))
    g = pairs.groupBy("party_size", "payment_method").agg(
        F.sum("_n").alias("total_bookings"),
        F.sum(F.when(F.col("is_fraud"), F.col("_n")).otherwise(F.lit(0))).alias("fraud_count"))
    return with_rate(g)


def flag_partials() -> dict:
    """Flags per booking: how many rows the left join gives it, and how many of
    them are fraud (partials of an incremental count)."""
    return {"_flags": ("count", "*"), "_frauds": ("count", F.when(F.col("flag") == "fraud", 1))}


def pair_counts(bookings_df: DataFrame, flag_counts: DataFrame, pay_counts: DataFrame) -> DataFrame:
    """(party_size, payment_method, total_bookings, fraud_count) out of counts
    per booking: flags (``flag_partials``) and payments. Equal to the gold view's
    counts; with inputs bucketed on booking_id nothing but the last partial
    sums is shuffled."""
    f = flag_counts.select("booking_id", "_flags", "_frauds")
    b = bookings_df.select("booking_id", F.col("guests_count").alias("party_size"))
    pays = pay_counts.select("booking_id", "payment_method", "_np")
    pairs = b.join(f, "booking_id", "left").join(pays, "booking_id")
    return pairs.groupBy("party_size", "payment_method").agg(
        F.sum(F.greatest(F.coalesce("_flags", F.lit(0)), F.lit(1)) * F.col("_np")).alias("total_bookings"),
        F.sum(F.coalesce("_frauds", F.lit(0)) * F.col("_np")).alias("fraud_count"))


def with_rate(counts: DataFrame) -> DataFrame:
    """The gold view from its counts."""
    return counts.select("party_size", "payment_method", "total_bookings", "fraud_count",
                         F.round(F.col("fraud_count") * 100.0 / F.col("total_bookings"), 2)
                          .cast("double").alias("fraud_rate_pct"))


def retracted(gold: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts of the gold view after some bookings changed: what they counted
    before is taken off, what they count now is added; a cell without a pair
    goes. All three reduce map-side to a row per cell."""
    cells = ["party_size", "payment_method"]
    off = before.select(*cells, (-F.col("total_bookings")).alias("total_bookings"),
                        (-F.col("fraud_count")).alias("fraud_count"))
    both = gold.select(*off.columns).unionByName(off).unionByName(after.select(*off.columns))
    return (both.groupBy(*cells).agg(F.sum("total_bookings").alias("total_bookings"),
                                     F.sum("fraud_count").alias("fraud_count"))
            .filter("total_bookings > 0"))


def fraud_rate_by(gold: DataFrame, dimension: str) -> DataFrame:
    """One-way fraud rate over one dimension of the gold view."""
    g = gold.groupBy(dimension).agg(F.sum("total_bookings").alias("total_bookings"),
                                    F.sum("fraud_count").alias("fraud_count"))
    return g.select(dimension, "total_bookings", "fraud_count",
                    F.round(F.col("fraud_count") * 100.0 / F.col("total_bookings"), 2)
                     .cast("double").alias("fraud_rate_pct"))


def fraud_independence(gold: DataFrame) -> DataFrame:
    """Pearson chi-square statistic for "fraud is independent of party size
    and payment method": cells = (party, method) x (fraud, not fraud),
    expected = row total * column share. One row: chi2, degrees of freedom,
    cells. Everything is an aggregate over the (small) gold view."""
    # the gold view has one row per (party_size, payment_method): a window
    # over all of it is bounded by the number of groups, not by the data
    whole = Window.partitionBy()
    g = gold.select("total_bookings", "fraud_count",
                    F.sum("total_bookings").over(whole).alias("_n"),
                    F.sum("fraud_count").over(whole).alias("_f"))
    share = F.when(F.col("_n") > 0, F.col("_f") / F.col("_n")).otherwise(F.lit(0.0))
    e_f = F.col("total_bookings") * share
    e_o = F.col("total_bookings") * (F.lit(1.0) - share)
    o_f = F.col("fraud_count")
    o_o = F.col("total_bookings") - F.col("fraud_count")
    term = (F.when(e_f > 0, (o_f - e_f) ** 2 / e_f).otherwise(0.0)
            + F.when(e_o > 0, (o_o - e_o) ** 2 / e_o).otherwise(0.0))
    return g.agg(F.round(F.sum(term), 6).alias("chi2"),
                    F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).cast("bigint").alias("dof"),
                    F.count(F.lit(1)).alias("cells"))


def chi2_p_value(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for a chi-square variable: one minus the regularised
    lower incomplete gamma function at a = dof / 2, x = statistic / 2, by its
    power series ``x^a e^-x / Gamma(a + 1) * (1 + x/(a+1) + x^2/((a+1)(a+2)) + ...)``.
    The terms grow up to the (x - a)-th and fall off within a few sqrt(x) behind
    it. From ``x = a + sqrt(40 a) + 20`` on the value is below e^-20 (the
    Laurent-Massart bound) and 0 is returned."""
    a, x = dof / F.lit(2.0), statistic / F.lit(2.0)
    # Gamma(a + 1) = a (a - 1) ... down to Gamma(1) = 1 or Gamma(1/2) = sqrt(pi)
    steps = F.sequence(F.lit(0), F.ceil(a).cast("int") - 1)
    log_gamma = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.log(a - i)) + F.when(
        dof % 2 == 1, F.lit(0.5) * F.log(F.pi())).otherwise(F.lit(0.0))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, n: Column) -> Column:
        term = acc["term"] * x / (a + n)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    far = x > a + F.sqrt(a * 40) + 20
    terms = F.ceil(F.greatest(F.when(far, F.lit(0.0)).otherwise(x - a), F.lit(0.0))
                   + F.sqrt(F.least(x, a * 2 + 300)) * 12 + 50).cast("int")
    series = F.aggregate(F.sequence(F.lit(1), terms), start, add, lambda acc: acc["sum"])
    lower = F.exp(a * F.log(x) - x - log_gamma) * series
    return (F.when(dof < 1, F.lit(None).cast("double")).when(x <= 0, F.lit(1.0))
            .when(far, F.lit(0.0))
            .otherwise(F.greatest(F.lit(1.0) - lower, F.lit(0.0))))


def fraud_significance(gold: DataFrame) -> DataFrame:
    """Pearson chi-square tests of "fraud is independent of ..." for party
    size, payment method, and their combination. Everything is an aggregate
    over the gold view, which has one row per combination. Rows: dimension,
    statistic, dof, p_value (both to 6 digits; null with fewer than two groups)."""
    label = lambda name, *cols: F.struct(
        F.lit(name).alias("dimension"), F.to_json(F.struct(*cols)).alias("level"))
    levels = F.explode(F.array(
        label("party_size", "party_size"), label("payment_method", "payment_method"),
        label("party_size x payment_method", "party_size", "payment_method")))
    cells = (gold.select(levels.alias("l"), "total_bookings", "fraud_count")
             .groupBy("l.dimension", "l.level")
             .agg(F.sum("total_bookings").alias("n"), F.sum("fraud_count").alias("f")))
    whole = Window.partitionBy("dimension")
    shared = cells.withColumn("share", F.sum("f").over(whole) / F.sum("n").over(whole))
    fraud_, other = F.col("n") * F.col("share"), F.col("n") * (1 - F.col("share"))
    off = F.pow(F.col("f") - fraud_, 2)         # both columns are off by as much
    term = F.when((fraud_ > 0) & (other > 0), off / fraud_ + off / other).otherwise(F.lit(0.0))
    tests = shared.groupBy("dimension").agg(F.sum(term).alias("s"),
                                            (F.count(F.lit(1)) - 1).cast("int").alias("dof"))
    return tests.select("dimension", F.round(F.when(F.col("dof") > 0, F.col("s")), 6).alias("statistic"),
                        "dof", F.round(chi2_p_value(F.col("s"), F.col("dof")), 6).alias("p_value"))
