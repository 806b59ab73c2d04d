import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnkit.operators import assemble as A
from churnkit.operators import features as FT

D = dt.date


@pytest.fixture(scope="module")
def bank(spark):
    customers = spark.createDataFrame(
        [("c1", "private", 5, "NY", "NY", "<50k"), ("c2", "mass", 2, "LA", "CA", "500k+"), ("c3", None, 1, "LA", "CA", None)],
        "customer_id string, tier string, tenure_years int, home_metro string, state string, annual_income_band string")
    holdings = spark.createDataFrame(
        [("c1", "PROD-DEP-1", 0.1, D(2024, 5, 1), "active"), ("c1", "PROD-DEP-1", 0.2, None, "active"),
         ("c1", "PROD-LN-1", 100.0, D(2023, 1, 1), "matured"), ("c2", "PROD-LN-1", 5.0, D(2023, 1, 1), "matured")],
        "customer_id string, product_id string, balance_usd double, maturity_date date, status string")
    txns = spark.createDataFrame(
        [("c1", D(2024, 3, 1), -10.0, "withdrawal"), ("c1", D(2024, 1, 1), -5.5, "transfer_out"),
         ("c1", D(2023, 12, 31), -99.0, "withdrawal"), ("c2", D(2024, 2, 1), 7.0, "deposit"), ("zz", D(2024, 3, 1), -1.0, "fee")],
        "customer_id string, txn_date date, amount_usd double, txn_type string")
    risk = spark.createDataFrame(
        [("c1", D(2024, 3, 1), 0.42, 7.0), ("c1", D(2024, 3, 1), 0.2, 9.0), ("c1", D(2024, 2, 1), 0.9, 1.0),
         ("c2", D(2024, 2, 1), 0.41, 0.0)],
        "customer_id string, snapshot_date date, attrition_risk_score double, balance_outflow_30d_usd double")
    return customers, holdings, txns, risk


def test_customer_360(spark, bank):
    got = {r.customer_id: r.asDict() for r in A.customer_360(*bank).collect()}
    assert set(got) == {"c1", "c2", "c3"}
    c1 = got["c1"]
    # the latest day is 2024-03-01, so the window opens on 2024-01-01 and includes it
    assert (c1["txn_count_60d"], c1["total_outflow_60d_usd"], c1["withdrawal_count_60d"]) == (2, -15.5, 2)
    assert (c1["num_products"], c1["total_balance_usd"], c1["num_deposit_products"], c1["has_maturing_cd"]) == (3, 100.3, 2, 1)
    assert (c1["attrition_risk_score"], c1["balance_outflow_30d_usd"], c1["tier_rank"]) == (0.42, 7.0, 3)
    assert got["c2"]["has_maturing_cd"] == 0 and got["c2"]["total_outflow_60d_usd"] == 0.0
    c3 = got["c3"]
    assert (c3["num_products"], c3["total_balance_usd"], c3["attrition_risk_score"], c3["tier_rank"]) == (0, 0.0, 0.0, 0)
    assert c3["tier"] is None


def test_customer_360_same_under_any_partitioning(bank, shuffle_parts):
    runs = shuffle_parts(lambda: FT.churn_label(A.customer_360(*bank)))
    assert runs[0] == runs[1] == runs[2]


def test_latest_by_uses_partial_limit(bank):
    df = A.latest_by(bank[3], ["customer_id"], [F.desc("snapshot_date"), F.desc("attrition_risk_score")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert {(r.customer_id, r.attrition_risk_score) for r in df.collect()} == {("c1", 0.42), ("c2", 0.41)}


def test_members(spark, bank):
    members = spark.createDataFrame([("c1",), ("c1",), ("q",)], "customer_id string")
    c = bank[0].select("customer_id")
    assert {r.customer_id: r.is_member for r in A.flag_members(c, "customer_id", members).collect()} == {
        "c1": True, "c2": False, "c3": False}
    assert [r[0] for r in A.keep_members(c, members, "customer_id").collect()] == ["c1"]
    assert A.drop_members(c, members, "customer_id").count() == 2


def test_dim_lookup_default(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    dim = spark.createDataFrame([("a", 0.5), ("b", None)], "p string, rate double")
    assert {r.p: r.rate for r in A.dim_lookup(df, dim, "p", "rate", 0.0).collect()} == {"a": 0.5, "b": 0.0, None: 0.0}


def test_expand_and_pair(spark):
    got = A.expand_days(spark.range(2), F.lit("2024-01-02").cast("date"), 3).collect()
    assert len(got) == 6 and {str(r.day) for r in got} == {"2024-01-02", "2024-01-01", "2023-12-31"}
    assert A.pair_with(spark.range(3), ["x", "y"], "t").count() == 6


def test_latest_preferred_falls_back(spark):
    df = spark.createDataFrame([("B", 1), ("B", 3), ("C", 9)], "k string, t int")
    assert A.latest_preferred(df, "k", ["A", "B", "C"], [F.desc("t")]).first().asDict() == {"k": "B", "t": 3}
    assert A.latest_preferred(df, "k", ["Z"], [F.desc("t")]).count() == 0


def test_top_at_risk(spark):
    df = spark.createDataFrame([("a", 5.0, 1, "x"), ("b", 9.0, 0, "x"), ("c", None, 1, "x"), ("d", 5.0, 1, "y"), ("e", 1.0, 1, "y")],
                               "customer_id string, v double, prediction int, tier string")
    assert [r.customer_id for r in A.top_at_risk(df, "v", 2).collect()] == ["a", "d"]
    got = A.top_at_risk(df, "v", 1, within="tier").collect()
    assert sorted(r.customer_id for r in got) == ["a", "d"]
    assert A.best_by(df, "v").first().customer_id == "b"


def test_label_rule(spark):
    df = spark.createDataFrame([(0.42, 0.0, 0, 0), (0.41, 0.0, 0, 0), (0.0, -1.0, 2, 1)],
                               "attrition_risk_score double, total_outflow_60d_usd double, tier_rank int, has_maturing_cd int")
    assert [round(r.p, 9) for r in df.select(FT.churn_probability().alias("p")).collect()] == [0.85, 0.06, 0.18]


def test_label_rate_follows_the_probabilities(spark):
    df = spark.range(20000).select(F.col("id").alias("customer_id"), F.lit(0.0).alias("attrition_risk_score"),
                                   F.lit(-1.0).alias("total_outflow_60d_usd"), F.lit(0).alias("tier_rank"),
                                   F.lit(0).alias("has_maturing_cd"))
    assert FT.churn_label(df).agg(F.avg("churned")).first()[0] == pytest.approx(0.12, abs=0.01)


def test_quartile_band(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(None,)], "v double")
    got = {r.v: r.b for r in FT.quartile_band(df, "v", "b").collect()}
    assert got == {1.0: 0.0, 2.0: 0.0, 3.0: 1.0, 4.0: 1.0, 5.0: 1.0, 6.0: 2.0, 7.0: 2.0, 8.0: 2.0, None: 2.0}


def test_select_features_refuses_leaks(bank):
    df = FT.churn_label(A.customer_360(*bank))
    ok = FT.select_features(df, ["customer_id"], FT.BASE_FEATURES, "churned", FT.LABEL_SOURCES)
    assert ok.columns == ["customer_id", *FT.BASE_FEATURES, "churned"]
    with pytest.raises(ValueError, match="attrition_risk_score"):
        FT.select_features(df, ["customer_id"], ["attrition_risk_score"], "churned", FT.LABEL_SOURCES)


def test_publish_features_checks_keys(spark):
    from churnkit.session import scratch_path
    ok = spark.createDataFrame([(1, 2.0), (2, None)], "k int, v double")
    assert FT.publish_features(ok, ["k"], scratch_path(spark, "pub")).count() == 2
    for bad in ([(1, 2.0), (1, 3.0)], [(None, 1.0), (2, 1.0)]):
        with pytest.raises(ValueError):
            FT.publish_features(spark.createDataFrame(bad, "k int, v double"), ["k"], scratch_path(spark, "pub"))


def test_split_is_disjoint_complete_and_stratified(spark, shuffle_parts):
    df = spark.range(10000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = FT.stratified_split(df, ["id"], "y")
    assert s.count() == 10000
    shares = {r.y: r.m for r in s.groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("m")).collect()}
    assert shares[0] == pytest.approx(0.2, abs=0.02) and shares[1] == pytest.approx(0.2, abs=0.05)
    exact = FT.stratified_split(df, ["id"], "y", exact=True)
    taken = {r.y: r.n for r in exact.filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert taken == {0: 1800, 1: 200}
    runs = shuffle_parts(lambda: exact)
    assert runs[0] == runs[1] == runs[2]


def test_class_weights_and_lookup(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    got = {r.y: (r.n, round(r.balanced_weight, 6), r.neg_pos_ratio) for r in FT.class_weights(df, "y").collect()}
    assert got == {0: (9, 0.555556, 9.0), 1: (1, 5.0, 9.0)}
    assert FT.class_weights(df.filter("y = 0"), "y").first().neg_pos_ratio == 9.0
    keys = spark.createDataFrame([(1,), (7,)], "k int")
    feats = spark.createDataFrame([(1, 2.5, None)], "k int, a double, b string")
    assert {r.k: (r.a, r.is_matched) for r in FT.lookup(keys, feats, ["a", "b"], "k").collect()} == {
        1: (2.5, True), 7: (None, False)}
