"""Sketches that add up: rolled-up ones equal direct ones, and estimates lie within what is promised."""

import datetime as dt
import math
import random

import pytest
from churnkit.operators import curves as CU
from churnkit.operators import evaluate as E
from churnkit.operators import sketches as K
from pyspark.sql import functions as F

LOG = "ts timestamp, model_version string, kind string, v double"


def _log(spark, n=6000, seed=1):
    rng = random.Random(seed)
    hot = lambda: 0.0 if rng.random() < 1 / 3 else rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 6)
    odd = [None, math.nan, math.inf, -math.inf, -0.0, 5e-324, 1.7e308]
    rows = [(dt.datetime(2024, 1, 1 + rng.randrange(14), rng.randrange(24)), rng.choice("ab"), rng.choice(["x", "y", None]), hot()) for _ in range(n)]
    rows += [(dt.datetime(2024, 1, 3), "a", "x", v) for v in odd]
    return spark.createDataFrame(rows, LOG), rows


def test_roll_up_equals_the_sketch_of_all_rows(spark, shuffle_parts):
    log, _ = _log(spark)
    week = F.date_trunc("week", "window_start")
    days = K.profile_sketches(log, ["v"], "ts", slices=["kind"]).filter("slice_key = 'kind'")
    got = lambda: K.roll_up(days, {"window_start": week, "model_version": F.col("model_version")})
    direct = K.profile_sketches(log.withColumn("ts", F.date_trunc("week", "ts")), ["v"], "ts").select(got().columns)
    want = sorted(map(str, direct.collect()))
    assert len(want) == 4 and all(r == want for r in shuffle_parts(got))


def test_estimates_keep_their_bounds(spark):
    log, rows = _log(spark)
    days = K.profile_sketches(log, ["v"], "ts")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    total = K.roll_up(days, {"column_name": F.col("column_name")})
    r = total.select("count", "nulls", "min", "max", K.distinct_estimate().alias("d"),
                     *[K.quantile_estimate(p).alias(f"q{i}") for i, p in enumerate(probs)]).collect()[0]
    known = sorted(v for *_, v in rows if v is not None and math.isfinite(v))
    assert (r["count"], r.nulls, r.min, r.max) == (len(rows), 4, known[0], known[-1])
    assert abs(r.d - len(set(known))) <= 4 * 0.023 * len(set(known))
    for i, p in enumerate(probs):
        want = known[max(1, math.ceil(p * len(known))) - 1]
        assert abs(r[f"q{i}"] - want) <= 0.0100001 * abs(want)


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], LOG)
    assert K.profile_sketches(empty, ["v"], "ts").count() == 0
    nulls = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", "x", None)] * 3, LOG)
    r = K.profile_sketches(nulls, ["v"], "ts").select("count", "nulls", "min", K.distinct_estimate().alias("d"), K.quantile_estimate(0.5).alias("q")).collect()
    assert [tuple(x) for x in r] == [(3, 3, None, 0.0, None)]
    few = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", "x", float(i % 7)) for i in range(70)], LOG)
    assert round(K.profile_sketches(few, ["v"], "ts").select(K.distinct_estimate()).collect()[0][0]) == 7


@pytest.mark.parametrize("kind", ["spread", "one value", "few values", "one bin", "in order", "against order", "odd", "no positives", "no negatives"])
@pytest.mark.parametrize("bins", [1, 8, 512])
def test_curve_areas_lie_within_their_errors(spark, kind, bins):
    rng = random.Random(kind)
    n = 400
    made = {
        "spread": lambda i: (rng.random(), int(rng.random() < 0.3)), "one value": lambda i: (0.5, i % 2),
        "few values": lambda i: (rng.choice([0.1, 0.11, 0.12, 0.9]), int(rng.random() < 0.5)),
        "one bin": lambda i: (0.5 + i * 1e-7, int(i > n // 2)), "in order": lambda i: (i / n, int(i > 300)),
        "against order": lambda i: (i / n, int(i < 100)), "odd": lambda i: (rng.choice([math.nan, math.inf, -math.inf, 2.0, -1.0, 0.3]), i % 3 % 2),
        "no positives": lambda i: (rng.random(), 0), "no negatives": lambda i: (rng.random(), 1)}
    rows = [(*made[kind](i), i % 3) for i in range(n)] + [(None, 1, 0), (0.5, None, 0)]
    df = spark.createDataFrame(rows, "s double, y int, part int")
    hist = CU.score_histogram(df, "y", "s", bins=bins)
    parts = CU.add_histograms(CU.score_histogram(df, "y", "s", ["part"], bins))
    assert sorted(map(tuple, hist.collect())) == sorted(map(tuple, parts.collect()))
    r = CU.curve_areas(parts).collect()[0]
    pr, roc = E.average_precision(df, "y", "s").collect()[0][0], E.roc_auc(df, "y", "s").collect()[0][0]
    assert abs(r.pr_auc - pr) <= r.pr_error + 1e-12
    if roc is None:
        assert r.roc_auc is None
    else:
        assert abs(r.roc_auc - roc) <= r.roc_error + 1e-12
    if kind == "spread" and bins == 512:
        assert r.pr_error < 0.02 and r.roc_error < 0.01


def test_curve_areas_by_group_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.1, 1), ("b", 0.9, 0)], "g string, s double, y int")
    got = {r.g: (r.pr_auc, r.roc_auc) for r in CU.curve_areas(CU.score_histogram(df, "y", "s", ["g"]), ["g"]).collect()}
    assert got == {"a": (1.0, 1.0), "b": (0.5, 0.0)}
    assert CU.curve_areas(CU.score_histogram(df.limit(0), "y", "s", ["g"]), ["g"]).count() == 0
