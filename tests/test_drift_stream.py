"""Drift as a stream against its batch form, over late rows, gaps and restarts; retried requests across batches."""

import datetime as dt
import random

from churnkit.operators import monitor as M
from churnkit.operators.payload import first_deliveries
from churnkit.session import scratch_path
from churnkit.streaming import drift, jobs

LOG = "ts timestamp, v double, kind string, model_version string"
EDGES = {"v": [0.0, 1.0, 2.0, 3.0]}
DAY = lambda d, h=0: dt.datetime(2024, 1, d, h)


def _rows(df):
    return sorted((r.column_name, r.drift_type, r.window.start, r.window.end, r.model_version, r.slice_key, r.slice_value, round(r.js_distance, 9))
                  for r in df.collect())


def test_drift_stream_equals_batch_over_late_rows_gaps_and_restarts(spark):
    rng = random.Random(3)
    src, root = scratch_path(spark, "t-log"), scratch_path(spark, "t-drift")
    make = lambda days, n: [(DAY(rng.choice(days), rng.randrange(24)), rng.uniform(-1, 4), rng.choice(["x", "y", None]),
                             rng.choice("ab")) for _ in range(n)]
    # day 4 to 6 have no rows; the second run meets rows that are too late; the last day stays open
    runs = [[*make([1, 2], 60), (DAY(2, 23), None, "x", "a")], make([3, 7], 60), [], make([8, 9, 20], 60)]
    late = [(DAY(1, 5), 2.5, "x", "a")] * 50
    on_time, schema = [], spark.createDataFrame([], LOG).schema
    for i, rows in enumerate(runs):
        spark.createDataFrame(rows + (late if i == 3 else []), LOG).coalesce(1).write.mode("append").parquet(src)
        on_time += rows
        drift.follow_drift(jobs.stream_parquet(spark, src, schema), "ts", EDGES, root, categorical=["kind"], version="model_version", slices=["kind"])
    dist = M.distributions(spark.createDataFrame(on_time, LOG), "ts", EDGES, ["kind"], "model_version", ["kind"])
    want = M.drift_consecutive(dist.filter("window_start < '2024-01-20'"))
    got = spark.read.parquet(f"{root}/drift")
    assert _rows(got) == _rows(want) and got.count() == got.select("window", "model_version", "slice_key", "slice_value", "column_name").distinct().count()


def test_distance_is_zero_between_equals_and_one_between_strangers():
    assert drift.distance({"a": 0.5, "b": 0.5}, {"a": 0.5, "b": 0.5}) == 0.0
    assert drift.distance({"a": 1.0}, {"b": 1.0}) == 1.0


def test_retries_are_dropped_across_batches_and_restarts(spark):
    ddl = "request_id string, at timestamp, body string"
    src, out, ck = (scratch_path(spark, n) for n in ("t-req", "t-once", "t-ck"))
    schema = spark.createDataFrame([], ddl).schema
    runs = [[("r1", DAY(1, 1), "first"), ("r2", DAY(1, 1), "first"), (None, DAY(1, 1), "same"), (None, DAY(1, 1), "same")],
            [("r1", DAY(1, 1), "again"), ("r3", DAY(1, 2), "first"), (None, DAY(1, 1), "same")],
            [("r3", DAY(1, 2), "again"), ("r2", DAY(1, 2), "again"), ("r4", DAY(1, 9), "first")],
            [("r9", DAY(1, 1), "too late"), ("r4", DAY(1, 9), "again"), ("r1", DAY(1, 9), "a new request under an old key")]]
    for rows in runs:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(src)
        stream = jobs.deliveries_stream(jobs.stream_parquet(spark, src, schema), "at", late="3 hours")
        jobs.to_parquet(stream, out, ck).awaitTermination()
    got = sorted((str(r.request_id), r.body) for r in spark.read.parquet(out).collect())
    assert got == sorted([("None", "same")] * 3 + [("r1", "a new request under an old key")] + [(f"r{i}", "first") for i in (1, 2, 3, 4)])


def test_first_deliveries(spark):
    rows = [("a", 2, "late"), ("a", 1, "x"), ("a", 1, "x"), ("b", 5, None), (None, 1, "n"), (None, 1, "n"), ("c", None, "untimed")]
    df = spark.createDataFrame(rows, "request_id string, timestamp_ms long, _row string")
    got = sorted(map(str, first_deliveries(df).collect()))
    want = [("a", 1, "x"), ("b", 5, None), (None, 1, "n"), (None, 1, "n"), ("c", None, "untimed")]
    assert got == sorted(map(str, spark.createDataFrame(want, df.schema).collect()))
    assert first_deliveries(df.limit(0)).count() == 0
