import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from churnkit.functions import columns as C


def test_hash_uniform_is_the_md5_draw(spark):
    got = spark.range(50).select("id", C.hash_uniform(7, "id").alias("u")).collect()
    for r in got:
        want = int(hashlib.md5(f"7|{r.id}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.u == want and 0 <= r.u < 1


def test_hash_uniform_ignores_partitioning(spark):
    a = spark.range(200).repartition(2).select("id", C.hash_uniform(1, "id").alias("u"))
    b = spark.range(200).repartition(5).select("id", C.hash_uniform(1, "id").alias("u"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_pick_reaches_both_ends(spark):
    got = spark.createDataFrame([(0.0,), (0.5,), (0.9999999,)], "u double").select(C.pick(["a", "b"], F.col("u")).alias("p"))
    assert [r.p for r in got.collect()] == ["a", "b", "b"]


def test_pick_weighted_thresholds(spark):
    us = [(0.0,), (0.449,), (0.45,), (0.8,), (0.95,)]
    t = C.pick_weighted([("deposit", 45), ("withdrawal", 35), ("fee", 10), ("interest", 10)], F.col("u"))
    got = [r.t for r in spark.createDataFrame(us, "u double").select(t.alias("t")).collect()]
    assert got == ["deposit", "deposit", "withdrawal", "fee", "interest"]


def test_amounts_and_ints(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.999,)], "u double")
    got = df.select(C.uniform_amount(100, 50, F.col("u")).alias("a"), C.uniform_int(3, 4, F.col("u")).alias("i")).collect()
    assert [(r.a, r.i) for r in got] == [(100.0, 3), (125.0, 5), (149.95, 6)]


def test_dates(spark):
    ref = F.lit("2024-03-10").cast("date")
    got = spark.createDataFrame([(0.0,), (0.99,)], "u double").select(
        C.date_draw(ref, 10, F.col("u")).alias("b"), C.date_draw(ref, 10, F.col("u"), 2, forward=True).alias("f")).collect()
    assert [(r.b, r.f) for r in got] == [(dt.date(2024, 3, 10), dt.date(2024, 3, 12)), (dt.date(2024, 3, 1), dt.date(2024, 3, 21))]


def test_make_key_keeps_long_numbers(spark):
    got = spark.createDataFrame([(5,), (12345678,)], "n long").select(C.make_key("C-", "n", 4).alias("k")).collect()
    assert [r.k for r in got] == ["C-0005", "C-12345678"]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a")], "x string, y string")
    assert df.select(C.surrogate_key("x", "y").alias("k")).distinct().count() == 3


def test_ordinal_default_and_null(spark):
    df = spark.createDataFrame([("private",), ("other",), (None,)], "t string")
    assert [r.r for r in df.select(C.ordinal("t", {"private": 3, "mass": 1}).alias("r")).collect()] == [3, 0, 0]


def test_maturity_status(spark):
    day = dt.date(2024, 1, 10)
    df = spark.createDataFrame([(dt.date(2024, 1, 9),), (day,), (None,)], "m date")
    assert [r.s for r in df.select(C.maturity_status("m", F.lit(day)).alias("s")).collect()] == ["matured", "active", "active"]


def test_scenario_shift(spark):
    df = spark.createDataFrame([("CUST-1", 0.0, 100.0, 0, 0, 1, 2), ("CUST-2", -10.0, 0.0, 1, 3, 0, 0)],
                               "customer_id string, total_outflow_60d_usd double, total_balance_usd double, has_maturing_cd int, "
                               "tier_rank int, withdrawal_count_60d int, txn_count_60d int")
    got = [tuple(r) for r in C.scenario_shift(df).collect()]
    assert got == [("CUST-D-1", -50000.0, 160.0, 1, 2, 9, 7), ("CUST-D-2", -50035.0, 0.0, 1, 4, 8, 5)]
    with pytest.raises(ValueError):
        C.scenario_shift(df, {"tier_rank": ("wobble", 1)})


def test_shift_time(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 4, 5),)], "ts timestamp")
    assert C.shift_time(df, "ts", "3 DAYS").first().ts == dt.datetime(2024, 1, 1, 5)
