import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.plans import fraud

BOOKINGS = "booking_id long, guests_count int"
FLAGS = "booking_id long, flag string, confidence double, reason string"
PAYMENTS = "booking_id long, payment_method string"


def _counted(b, f, p):
    """The gold view by counting every (booking, flag, payment) triple."""
    total, fraud_ = Counter(), Counter()
    for booking, guests in map(tuple, b.collect()):
        flags = [r.flag == "fraud" for r in f.collect() if r.booking_id == booking] or [False]
        for r in p.collect():
            if r.booking_id == booking:
                total[guests, r.payment_method] += len(flags)
                fraud_[guests, r.payment_method] += sum(flags)
    return sorted((*k, n, fraud_[k], round(100.0 * fraud_[k] / n, 2)) for k, n in total.items())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fan_out_and_missing_matches(spark):
    b = spark.createDataFrame([(1, 2), (2, 2), (3, 4), (4, 4)], BOOKINGS)
    f = spark.createDataFrame([(1, "fraud", 0.9, "unusual_location"),
                               (1, "fraud", 0.8, "stolen_card_report"),   # two flags
                               (3, "fraud", 0.7, "suspicious_pattern")], FLAGS)
    p = spark.createDataFrame([(1, "card"), (2, "card"), (2, "card"),     # two payments
                               (3, "cash")], PAYMENTS)                    # 4: no payment
    bwf = fraud.bookings_with_fraud(b, f)
    assert bwf.count() == 5                                   # booking 1 twice
    assert bwf.filter("booking_id = 2").first().is_fraud is False
    assert bwf.filter("booking_id = 4").first().fraud_reason is None
    got = fraud.fraud_by_party_and_method(bwf, p)
    assert rows(got) == _counted(b, f, p)
    card = got.filter("party_size = 2 AND payment_method = 'card'").first()
    assert (card.total_bookings, card.fraud_count) == (4, 2)


def test_hot_booking_pre_aggregated(spark):
    # one booking holds most payments; the result must equal the plain join
    b = spark.createDataFrame([(i, 1 + i % 6) for i in range(50)], BOOKINGS)
    f = spark.createDataFrame([(7, "fraud", 0.9, "unusual_location")], FLAGS)
    p = spark.createDataFrame([(7, "card")] * 300 + [(i, "cash") for i in range(50)], PAYMENTS)
    got = fraud.fraud_by_party_and_method(fraud.bookings_with_fraud(b, f), p)
    assert rows(got) == _counted(b, f, p)


def test_hot_flags_are_not_shuffled(spark):
    """A third of all flags lies on one booking: same rows as the plain left
    join, and no task joins all of its flags."""
    b = spark.createDataFrame([*((i, 1 + i % 6) for i in range(500)), (None, 3)], BOOKINGS)
    f = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
         .when(F.col("id") % 50 == 2, F.lit(9_999)).otherwise(F.col("id") % 400).alias("booking_id"),
        F.when(F.col("id") % 5 == 0, F.lit("cleared")).when(F.col("id") % 7 != 0, F.lit("fraud")).alias("flag"),
        (F.col("id") % 90 / 100).alias("confidence"), F.lit("suspicious_pattern").alias("reason"))
    assert fraud.hot_bookings(f, 4, 100) == [7]
    counts = f.groupBy("booking_id").agg(*[F.count(F.lit(1)).alias("_flags")])
    assert fraud.hot_bookings(f, 4, 100, counts) == [7] and fraud.hot_bookings(f, 4) == []
    plain, got = fraud.bookings_with_fraud(b, f), fraud.bookings_with_fraud(b, f, [7])
    assert got.columns == plain.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    tasks = got.filter("booking_id = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) <= 400
    assert fraud.hot_bookings(f.limit(0), 4, 0) == [] and fraud.hot_bookings(f, 4, 0, counts.limit(0)) == []


def test_empty_inputs(spark):
    b = spark.createDataFrame([], BOOKINGS)
    f = spark.createDataFrame([], FLAGS)
    p = spark.createDataFrame([], PAYMENTS)
    got = fraud.fraud_by_party_and_method(fraud.bookings_with_fraud(b, f), p)
    assert got.count() == 0
    assert got.columns == ["party_size", "payment_method", "total_bookings", "fraud_count",
                           "fraud_rate_pct"]


def test_one_way_rates_and_chi2(spark):
    gold = spark.createDataFrame(
        [(1, "a", 100, 10, 10.0), (1, "b", 100, 10, 10.0), (2, "a", 100, 10, 10.0)],
        "party_size int, payment_method string, total_bookings long, fraud_count long, "
        "fraud_rate_pct double")
    chi = fraud.fraud_independence(gold).first()
    assert chi.chi2 == 0.0 and chi.dof == 2 and chi.cells == 3
    by = {r.party_size: r for r in fraud.fraud_rate_by(gold, "party_size").collect()}
    assert by[1].total_bookings == 200 and by[1].fraud_rate_pct == 10.0
    skew = gold.withColumn("fraud_count", F.when(F.col("party_size") == 2, 50)
                           .otherwise(F.col("fraud_count")))
    assert fraud.fraud_independence(skew).first().chi2 > 10


def test_significance_matches_chi2_statistic(spark):
    gold = spark.createDataFrame(
        # both party sizes 40/200 fraud; method a 20/200 vs method b 60/200
        [(1, "a", 100, 10, 0.0), (1, "b", 100, 30, 0.0), (2, "a", 100, 10, 0.0), (2, "b", 100, 30, 0.0)],
        "party_size int, payment_method string, total_bookings long, fraud_count long, "
        "fraud_rate_pct double")
    sig = {r.dimension: r for r in fraud.fraud_significance(gold).collect()}
    joint = fraud.fraud_independence(gold).first()
    assert abs(sig["party_size x payment_method"].statistic - joint.chi2) < 1e-6
    assert sig["party_size x payment_method"].dof == 3
    assert sig["payment_method"].p_value < 0.001 and sig["party_size"].p_value > 0.99


def _p(spark, statistic, dof):
    from tierline.plans.fraud import chi2_p_value
    df = spark.createDataFrame([(statistic, dof)], "s double, d int")
    return df.select(chi2_p_value(F.col("s"), F.col("d")).alias("p")).first().p


@pytest.mark.parametrize("statistic,dof,p", [
    (50.0, 1, 0.0), (3.841459, 1, 0.05), (18.307038, 10, 0.05), (0.5, 40, 1.0), (63.690740, 40, 0.01)])
def test_p_values_of_few_groups(spark, statistic, dof, p):
    assert abs(_p(spark, statistic, dof) - p) < 1e-6


@pytest.mark.parametrize("statistic,dof", [
    (400_000.0, 400_000), (400_300.0, 400_000), (403_600.0, 400_000), (4_000_000.0, 400_000),
    (9_999.0, 9_999), (10_600.0, 9_999), (9_000.0, 9_999), (12_000.0, 3_000)])
def test_p_values_of_many_groups(spark, statistic, dof):
    """Against Wilson and Hilferty's cube root, good to some 1e-5 here."""
    z = ((statistic / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / math.sqrt(2 / (9 * dof))
    assert abs(_p(spark, statistic, dof) - 0.5 * math.erfc(z / math.sqrt(2))) < 2e-5


def test_sql_form_counts_flags_that_are_not_fraud(spark, root):
    """A cleared and a null flag multiply payments and are no fraud, in SQL as
    in the DataFrame form."""
    from tierline import tables
    from tierline.plans import fraud, sql
    bookings = spark.createDataFrame([(1, 2), (2, 2), (3, 4)], "booking_id long, guests_count int")
    flags = spark.createDataFrame(
        [(1, "fraud", "r", "t", 0.9), (1, "cleared", "r", "t", 0.9), (2, None, "r", "t", 0.9)],
        fraud.FLAG_SCHEMA)
    payments = spark.createDataFrame([(1, "card"), (2, "card"), (3, "cash")],
                                     "booking_id long, payment_method string")
    names = {}
    for name, df in (("bookings", bookings), ("fraud_flags", flags), ("payments", payments)):
        names[name] = f"{name}_{root.rsplit('-', 1)[1]}"
        tables.publish_table(df, root, names[name])
    got = spark.sql(sql.FRAUD_BY_PARTY_AND_METHOD.format(**names))
    want = fraud.fraud_by_party_and_method(fraud.bookings_with_fraud(bookings, flags), payments)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert (2, "card", 3, 1, 33.33) in set(map(tuple, got.collect()))
