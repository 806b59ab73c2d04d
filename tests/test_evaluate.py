import random

import pytest
from pyspark.sql import functions as F

from churnkit.operators import evaluate as E


def brute_ap(rows):
    pos = sum(y for y, _ in rows)
    total, seen = 0.0, 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, t in rows if t >= s and y)
        n = sum(1 for _, t in rows if t >= s)
        total += (tp / pos - seen) * tp / n
        seen = tp / pos
    return total


def brute_auc(rows):
    p, n = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 else "cold", int(rnd.random() < 0.3), round(rnd.random(), 1 if i % 2 else 3)) for i in range(400)]
    return rows, spark.createDataFrame(rows, "model string, y int, score double").cache()


def test_ranking_metrics_equal_brute_force(scored, shuffle_parts):
    rows, df = scored
    got = {r.model: r for r in E.ranking_metrics(df, "y", "score", ["model"]).collect()}
    for m in ("hot", "cold"):
        own = [(y, s) for k, y, s in rows if k == m]
        assert got[m].pr_auc == pytest.approx(brute_ap(own))
        assert got[m].roc_auc == pytest.approx(brute_auc(own))
    every = [(y, s) for _, y, s in rows]
    assert E.average_precision(df, "y", "score").first().pr_auc == pytest.approx(brute_ap(every))
    assert E.roc_auc(df, "y", "score").first().roc_auc == pytest.approx(brute_auc(every))


def test_ranking_metrics_of_one_class(spark):
    ones = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, score double")
    assert E.roc_auc(ones, "y", "score").first().roc_auc is None
    assert E.average_precision(ones, "y", "score").first().pr_auc == 1.0
    zeros = ones.withColumn("y", F.lit(0))
    assert E.average_precision(zeros, "y", "score").first().pr_auc == 0.0


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "y int, p int")
    r = E.class_metrics(df, "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 0, 1, 0)
    assert (r.precision_pos, r.recall_pos) == (0.0, 0.0)
    assert r.accuracy == pytest.approx(2 / 3) and r.macro_f1 == pytest.approx(0.4)


def test_class_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    got = {r["class"]: (round(r.precision, 4), round(r.recall, 4), round(r.f1, 4), r.support)
           for r in E.class_report(df, "y", "p").collect()}
    assert got == {"0": (0.6667, 0.6667, 0.6667, 3), "1": (0.5, 0.5, 0.5, 2), "macro avg": (0.5833, 0.5833, 0.5833, 5),
                   "weighted avg": (0.6, 0.6, 0.6, 5)}


def test_share_shift_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 1)], "y int, p int")
    assert {r["class"]: (r.actual_pct, r.predicted_pct) for r in E.share_shift(df, "y", "p").collect()} == {
        0: (75.0, 25.0), 1: (25.0, 75.0)}
    r = E.accuracy(df, "y", "p").first()
    assert (r.n, r.incorrect, r.accuracy) == (4, 2, 0.5)


def test_parity(spark):
    a = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "k int, prediction int")
    same = E.parity(a, a, "k").first()
    assert (same.compared, same.identical, same.identical_pct) == (3, 3, 100.0)
    b = a.withColumn("prediction", F.when(F.col("k") == 2, 0).otherwise(F.col("prediction")))
    assert E.parity(a, b, "k").first().identical == 2
    assert [tuple(r) for r in E.parity_diff(a, b, "k").collect()] == [(2, 1, 0)]


@pytest.mark.parametrize("value,ok", [(0.39, False), (0.40, True), (0.41, True)])
def test_approval_gate(spark, value, ok):
    m = spark.createDataFrame([("7", "test_f1", value), ("7", "eval_accuracy", 0.1)], "version string, metric string, value double")
    r = E.approve(m).first()
    assert r.approved is ok and (" meets " if ok else " misses ") in r.reason


def test_approval_without_the_metric(spark):
    m = spark.createDataFrame([("7", "other", 0.9)], "version string, metric string, value double")
    assert E.approve(m).first().approved is False


def test_resolve_version(spark):
    rows = [(1, "champion"), (2, "champion"), (9, "dev")]
    df = spark.createDataFrame(rows, "version int, alias string")
    assert E.resolve_version(df).first().version == 2
    assert E.resolve_version(df.filter("alias = 'dev'")).first().version == 9


def test_eval_log_and_leaderboard(spark, scored):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "k int, y int")
    preds = spark.createDataFrame([(1, 5.0, 1.0), (2, 6.0, 1.0)], "k int, f double, prediction double")
    assert {r.k: r.correct for r in E.eval_log(labels, preds, "k", ["f"], "y").collect()} == {1: False, 2: True}
    df = scored[1].withColumn("yhat", (F.col("score") > 0.5).cast("int"))
    board = E.leaderboard(df, "model", "y", "score", "yhat").collect()
    assert board[0].pr_auc >= board[1].pr_auc
    long = E.metrics_long(E.class_metrics(df, "y", "yhat"), "3", ["macro_f1", "accuracy"]).collect()
    assert {r.metric for r in long} == {"macro_f1", "accuracy"} and {r.version for r in long} == {"3"}
