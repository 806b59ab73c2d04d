import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators import monitor as M

EDGES = {"v": [0.0, 1.0, 2.0, 3.0]}


def _log(spark, days):
    """``days`` maps a day to its values."""
    rows = [(dt.datetime(2024, 1, d, 6), float(v) if v is not None else None, int((v or 0) > 1), "m", "s" if i % 2 else None)
            for d, vs in days.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "ts timestamp, v double, prediction int, model_version string, slice string")


def _js(p, q):
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(total, 0.0))


def _overall(drift, column="v"):
    rows = drift.filter((F.col("column_name") == column) & (F.col("slice_key") == "all")).collect()
    return {r.window.start.day: r.js_distance for r in rows}


def test_equal_windows_have_no_distance(spark):
    log = _log(spark, {1: [0.5, 1.5, 2.5], 2: [0.5, 1.5, 2.5], 3: [0.2, 1.2, 2.2]})
    got = _overall(M.drift_consecutive(M.distributions(log, "ts", EDGES, ["prediction"], "model_version")))
    assert got == {2: 0.0, 3: 0.0}


def test_shifted_window_matches_the_formula(spark):
    log = _log(spark, {1: [0.5, 0.6, 1.5, 2.5], 2: [2.5, 2.6, 2.7, 1.5], 5: [0.5, 0.5]})
    got = _overall(M.drift_consecutive(M.distributions(log, "ts", EDGES)))
    assert set(got) == {2, 5}
    assert got[2] == pytest.approx(_js([0.5, 0.25, 0.25], [0, 0.25, 0.75]))
    assert got[5] == pytest.approx(1.0)  # no bin in common


def test_drift_is_symmetric_and_bounded(spark):
    a, b = [0.5, 0.6, 1.5, 2.5, None], [2.5, 2.6, 2.7, 1.5]
    one = _overall(M.drift_consecutive(M.distributions(_log(spark, {1: a, 2: b}), "ts", EDGES)))[2]
    two = _overall(M.drift_consecutive(M.distributions(_log(spark, {1: b, 2: a}), "ts", EDGES)))[2]
    assert one == pytest.approx(two) and 0 < one <= 1


def test_single_window_has_no_consecutive_drift(spark):
    d = M.distributions(_log(spark, {1: [0.5, 1.5]}), "ts", EDGES)
    assert M.drift_consecutive(d).count() == 0


def test_shares_sum_to_one_and_outside_values_join_the_end_bins(spark):
    log = _log(spark, {1: [-9.0, 0.0, 99.0, None, 1.0]})
    d = M.distributions(log, "ts", EDGES, ["prediction"], "model_version", ["slice"])
    sums = d.groupBy("window_start", "slice_key", "slice_value", "column_name").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 2 * 3 and all(r.s == pytest.approx(1.0) for r in sums)
    bins = {r.bin: r.n for r in d.filter("column_name = 'v' AND slice_key = 'all'").collect()}
    assert bins == {"0": 3, "2": 1, "null": 1}


def test_baseline_drift(spark):
    log = _log(spark, {1: [0.5, 1.5], 2: [2.5, 2.5]})
    base = M.baseline_shares(log.filter("v < 2"), EDGES)
    got = _overall(M.drift_baseline(M.distributions(log, "ts", EDGES), base))
    assert got[1] == 0.0 and got[2] == pytest.approx(1.0)
    assert M.drift_view(M.drift_baseline(M.distributions(log, "ts", EDGES), base), ["prediction"]).count() == 0


def test_profile_metrics(spark):
    log = _log(spark, {1: [1.0, 1.0, 3.0, None], 2: [5.0]})
    for exact in (True, False):
        got = M.profile_metrics(log, ["v"], "ts", slices=["slice"], quantiles={"p50": 0.5}, exact=exact)
        rows = {(r.window_start.day, r.slice_value): r for r in got.collect()}
        r = rows[1, "all"]
        assert (r["count"], r.nulls, r.min, r.max, r.distinct_count, r.p50) == (4, 1, 1.0, 3.0, 2, 1.0)
        assert r["mean"] == pytest.approx(5 / 3) and r["stddev"] == pytest.approx(math.sqrt(4 / 3))
        assert rows[2, "all"]["stddev"] is None and rows[2, "null"]["count"] == 1


def test_quality_checks(spark):
    log = _log(spark, {1: [1.0] * 10, 2: [1.0] * 11, 3: [1.0] * 10, 4: [None] * 40 + [1.0] * 60})
    want = T.StructType([f for f in log.schema.fields if f.name != "slice"] + [T.StructField("gone", T.StringType())])
    rows = {r.window_start.day: r for r in M.quality_checks(log, ["v", "slice"], "ts", expected=want).filter(
        "column_name = 'v'").collect()}
    assert [rows[d].volume_anomaly for d in (1, 2, 3, 4)] == [False, False, False, True]
    assert rows[4].null_rate_change == pytest.approx(0.4) and rows[1].null_rate_change is None
    assert M.schema_changes(log, want) == [("gone", "missing"), ("slice", "added")]


def test_custom_metric(spark):
    got = M.custom_metric(_log(spark, {1: [1.0, 3.0]}), "mx", "max(v)", "ts", ["slice"]).collect()
    assert {(r.slice_value, r.value) for r in got} == {("all", 3.0), ("s", 3.0), ("null", 1.0)}


DRIFT = ("column_name string, drift_type string, window struct<start:timestamp,end:timestamp>, model_version string, "
         "slice_key string, slice_value string, js_distance double")


def _drift(spark, rows):
    return spark.createDataFrame(
        [(c, k, (dt.datetime(2024, 1, d), dt.datetime(2024, 1, d + 1)), "1", s, "all", js) for c, k, d, s, js in rows], DRIFT)


@pytest.mark.parametrize("rows,threshold,force,needed,part", [
    ([], 0.0, False, False, "no drift rows"),
    ([], 0.0, True, True, "forced"),
    ([("prediction", "CONSECUTIVE", 2, "all", 0.3)], 0.2, False, True, "0.3000"),
    ([("prediction", "CONSECUTIVE", 2, "all", 0.2)], 0.2, False, True, "reaches"),
    ([("prediction", "CONSECUTIVE", 2, "all", 0.1)], 0.2, False, False, "stays below"),
    ([("prediction", "CONSECUTIVE", 2, "all", None)], 0.0, False, False, "null"),
    ([("prediction", "CONSECUTIVE", 2, "all", 0.1), ("prediction", "CONSECUTIVE", 1, "all", 0.9)], 0.2, False, False, "0.1000"),
    ([("prediction", "BASELINE", 9, "all", 0.9), ("prediction", "CONSECUTIVE", 1, "all", 0.1)], 0.2, False, False, "CONSECUTIVE"),
    ([("prediction", "BASELINE", 2, "all", 0.9)], 0.2, False, True, "BASELINE"),
    ([("prediction", "SEQUENTIAL", 2, "all", 0.9)], 0.2, False, True, "SEQUENTIAL"),
    ([("prediction", "CONSECUTIVE", 2, "tier", 0.9)], 0.2, False, False, "no drift rows"),
    ([("prediction", "CONSECUTIVE", 2, "all", 0.1), ("prediction", "CONSECUTIVE", 2, "all", 0.5)], 0.2, False, True, "0.5000"),
    ([("v", "CONSECUTIVE", 2, "all", 0.9)], 0.2, False, False, "no drift rows"),
])
def test_drift_gate(spark, rows, threshold, force, needed, part):
    got = M.drift_gate(_drift(spark, rows), threshold, force).collect()
    assert len(got) == 1
    assert got[0].retrain_needed is needed and part in got[0].reason


def test_retrain_decision(spark):
    approval = spark.createDataFrame([("1", True, "a"), ("2", False, "b")], "version string, approved boolean, reason string")
    trip = M.drift_gate(_drift(spark, []), 0.0, force=True)
    calm = M.drift_gate(_drift(spark, []), 0.0)
    assert {r.version: r.action for r in M.retrain_decision(trip, approval, "m").collect()} == {"1": "promote", "2": "reject"}
    assert {r.action for r in M.retrain_decision(calm, approval, "m").collect()} == {"keep"}
    assert M.retrain_decision(trip, approval.limit(0), "m").first().action == "train"


def test_numeric_edges_and_window_change(spark):
    log = _log(spark, {1: range(10), 2: range(10)})
    e = M.numeric_edges(log, ["v"], 3)["v"]
    assert e[0] == 0.0 and e[-1] == 9.0 and len(e) == 4
    per = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 1, 1)], "k string, w int, n int")
    got = {(r.k, r.w): r.n_change for r in M.window_change(per, ["k"], "w", ["n"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 4, ("b", 1): None}
