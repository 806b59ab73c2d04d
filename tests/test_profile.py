import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnkit.operators import evaluate as E
from churnkit.operators import profile as P
from churnkit.operators.order import exact_quantiles


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, "xyz"[i % 3], float(i % 7) if i % 5 else None, i % 2, 3.0) for i in range(60)]
    return spark.createDataFrame(rows, "id int, g string, v double, y int, const double").cache()


def test_null_and_duplicate_counts(spark, frame):
    assert {r.column: r.nulls for r in P.null_counts(frame).collect()} == {"id": 0, "g": 0, "v": 12, "y": 0, "const": 0}
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "a")], "k int, s string")
    assert tuple(P.duplicate_count(df).first()) == (5, 2, 3)
    assert tuple(P.duplicate_count(df.limit(0)).first()) == (0, 0, 0)


def test_describe_equals_pandas(frame):
    got = {r.column: r for r in P.describe(frame, approx=False).collect()}
    want = frame.toPandas()["v"].describe()
    r = got["v"]
    assert (r["count"], r["min"], r["max"]) == (48, 0.0, 6.0)
    assert [r["mean"], r["stddev"], r.p25, r.p50, r.p75] == pytest.approx(
        [want[k] for k in ("mean", "std", "25%", "50%", "75%")])
    assert (got["g"].first_text, got["g"].last_text, got["g"].mean) == ("x", "z", None)
    assert {r.column for r in P.describe(frame).collect()} == set(frame.columns)


def test_correlations(frame):
    cols = ["id", "v", "y", "const"]
    got = {(r.col_a, r.col_b): r.corr for r in P.corr_matrix(frame, cols).collect()}
    want = frame.toPandas()[cols].corr()
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) if pd.isna(w) else r == pytest.approx(w)
    top = P.top_pairs(frame, ["id", "v", "y"], 2).collect()
    assert abs(top[0].corr) >= abs(top[1].corr) and len(top) == 2
    tc = P.target_corr(frame, ["id", "v"], "y").collect()
    assert tc[0].strength >= tc[1].strength and tc[0].direction in ("positive", "negative")


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3, 3, 3, 4, 4, 5, 100]], "v double")
    r = P.iqr_outliers(df, ["v"]).first()
    assert (r.outliers, r.outlier_pct) == (1, 10.0)
    q = df.toPandas().v.quantile([0.25, 0.75]).tolist()
    assert [r.q1, r.q3] == pytest.approx(q)


def test_bins_follow_right_closed_quantiles(frame):
    pdf = frame.toPandas().dropna(subset=["v"])
    got = {r.bin: (r.n, r.rate) for r in P.rate_by_bin(frame, "v", "y", 5).collect()}
    want = pdf.groupby(pd.qcut(pdf.v, 5, duplicates="drop", labels=False)).y.agg(["size", "mean"])
    assert {int(k): (int(r["size"]), pytest.approx(r["mean"])) for k, r in want.iterrows()} == got


def test_bins_of_a_constant_are_equal_width(frame):
    edges = P.bin_edges(frame, "const", 5)
    assert len(edges) == 6 and edges[0] < 3.0 < edges[-1]
    assert [(r.n) for r in P.rate_by_bin(frame, "const", "y", 5).collect()] == [60]
    assert P.rate_by_bin(frame.limit(0), "v", "y").count() == 0


def test_box_stats_and_five_num(frame):
    pdf = frame.toPandas()
    for r in P.box_stats(frame, ["v"], "y").collect():
        v = pdf[pdf.y == r.y].v.dropna()
        assert [r.q1, r.median, r.q3] == pytest.approx(v.quantile([0.25, 0.5, 0.75]).tolist())
        assert (r.whisker_low, r.whisker_high, r.outliers) == (v.min(), v.max(), 0)
    r = P.five_num(frame, "g", "v").filter("g = 'x'").first()
    x = pdf[pdf.g == "x"].v.dropna()
    assert [r.min, r.q1, r.median, r.q3, r.max] == pytest.approx(x.quantile([0, 0.25, 0.5, 0.75, 1]).tolist())


def test_round_summary_counts_failed_batches(spark):
    rows = [(1, "o", 0, 1, True), (1, "o", 0, 0, True), (1, "d", 0, None, False), (2, "o", 0, 1, True), (3, "o", 0, None, False)]
    df = spark.createDataFrame(rows, "round int, cohort string, batch int, prediction int, ok boolean")
    got = {(r.scope, r.round): (r.predictions, r.positives, r.positive_rate, r.batches, r.errors)
           for r in P.round_summary(df).collect()}
    assert got == {("round", 1): (2, 1, 0.5, 2, 1), ("round", 2): (1, 1, 1.0, 1, 0), ("round", 3): (0, 0, 0.0, 1, 1),
                   ("overall", None): (3, 2, 2 / 3, 4, 2)}


def test_sample_n_is_the_same_on_every_layout(spark):
    df = spark.range(300)
    a, b = ([r.id for r in P.sample_n(x, ["id"], 40, 9).collect()] for x in (df, df.repartition(7)))
    assert a == b and len(set(a)) == 40
    assert P.sample_n(df, ["id"], 1000, 9).count() == 300


def test_sliced_agg_and_compare_means(frame):
    got = {(r.slice_key, r.slice_value): r.n for r in P.sliced_agg(frame, ["g", "y"], {"n": F.count("*")}).collect()}
    assert got == {(None, None): 60, ("g", "x"): 20, ("g", "y"): 20, ("g", "z"): 20, ("y", "0"): 30, ("y", "1"): 30}
    r = P.compare_means(frame, frame.withColumn("v", F.col("v") + 2), ["v"]).first()
    assert r.mean_drifted - r.mean_original == pytest.approx(2.0)


def test_class_balance_and_shape(frame):
    assert {r.y: (r.n, r.pct) for r in P.class_balance(frame, "y").collect()} == {0: (30, 50.0), 1: (30, 50.0)}
    assert {(r.data_type, r.n_columns, r.n_rows) for r in P.shape(frame).collect()} == {
        ("int", 2, 60), ("string", 1, 60), ("double", 2, 60)}


def test_describe_covers_times_and_refuses_what_has_no_order(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-02 03:04:05', DATE '2024-01-01', true), (NULL, DATE '2023-01-01', false) t(t, d, b)")
    got = {r.column: (r["count"], r.first_text, r.last_text) for r in P.describe(df).collect()}
    assert got == {"t": (1, "2024-01-02 03:04:05", "2024-01-02 03:04:05"), "d": (2, "2023-01-01", "2024-01-01"), "b": (2, "false", "true")}
    with pytest.raises(ValueError):
        P.describe(df.select(F.array("b").alias("a")))


def _evaluations(spark, df, run):
    """How often ``run`` reads its input, which comes in as many tasks as it has partitions."""
    seen, parts = spark.sparkContext.accumulator(0), df.rdd.getNumPartitions()

    def look(batches):
        seen.add(1)
        yield from batches

    run(df.mapInArrow(look, df.schema))
    return seen.value / parts


def test_correlation_of_a_wide_table_takes_one_scan(spark):
    """163 columns with missing values, large offsets and a constant one, against pandas; the input is read once."""
    names = [f"c{i}" for i in range(163)]
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(500, 163)) + rnd.normal(size=(500, 1)) + 1e6 * np.arange(163)
    x[:, 5] = 7.0
    pdf = pd.DataFrame(x, columns=names).mask(pd.DataFrame(rnd.random((500, 163)) < 0.1, columns=names))
    df = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in pdf.itertuples(index=False)], ", ".join(f"{n} double" for n in names)).repartition(6)
    got = {}
    assert _evaluations(spark, df, lambda d: got.update({(r.col_a, r.col_b): r["corr"] for r in P.corr_matrix(d, names).collect()})) == 1
    assert len(got) == 163 * 163
    want = pdf.corr(min_periods=2)
    for a in names:
        for b in names:
            if "c5" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-7)  # means of 1e8 are known to 1e-8


def test_correlation_of_odd_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, float("nan"), 1.0), (3.0, 5.0, None), (5.0, 1.0, 2.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in P.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] != got["a", "b"] and got["a", "c"] == pytest.approx(1.0) and got["a", "a"] == pytest.approx(1.0)
    assert P.corr_matrix(df, []).count() == 0 and P.corr_matrix(df.limit(0), ["a", "b"]).filter("corr IS NOT NULL").count() == 0


def test_moments_merge_in_any_order():
    from churnkit.operators.moments import batch_moments, merge
    rnd = np.random.default_rng(3)
    x, missing = rnd.normal(1e5, 1, (90, 4)), rnd.random((90, 4)) < 0.4
    whole = batch_moments(x, missing)
    parts = [batch_moments(x[a:b], missing[a:b]) for a, b in ((0, 1), (1, 40), (40, 90))]
    for order in ((0, 1, 2), (2, 0, 1)):
        got = merge(merge(parts[order[0]], parts[order[1]]), parts[order[2]])
        for k in whole:
            assert got[k] == pytest.approx(whole[k], rel=1e-9, abs=1e-7), k


def test_duplicates_with_one_digest_for_all(spark):
    """Every digest collides: the rows themselves decide. Null and empty are different."""
    rows = [(1, None, 0.0), (1, "", 0.0), (None, "1", 0.0), (1, None, -0.0), (2, "x", float("nan")), (2, "x", float("nan")), (3, "y", 1.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    want = (7, 5, 2)
    assert tuple(P.duplicate_count(df).first()) == want
    assert tuple(P.duplicate_count(df, F.lit(1)).first()) == want
    assert tuple(P.duplicate_count(df, F.col("a") % 2).first()) == want


def test_digests_are_what_is_shuffled(spark):
    df = spark.range(50).selectExpr("id", "repeat('long', 100) AS text", "id % 7 AS k")
    plan = P.duplicate_count(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_d" in plan


def test_quantiles_read_their_input_three_times(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS g", "pmod(xxhash64(id), 100000) / 7 AS v", "id * 1.0 AS w").repartition(4)
    for by in ([], ["g"]):
        assert _evaluations(spark, df, lambda d, by=by: exact_quantiles(d, ["v", "w"], [0.05, 0.25, 0.5, 0.9], by).collect()) == 3


def test_curves_read_their_input_once(spark):
    df = spark.range(5_000).selectExpr("id", "pmod(xxhash64(id), 997) / 997 AS p", "cast(id % 3 = 0 as int) AS y").repartition(4)
    assert _evaluations(spark, df, lambda d: E.average_precision(d, "y", "p").collect()) == 1
    assert _evaluations(spark, df, lambda d: E.roc_auc(d, "y", "p").collect()) == 1
