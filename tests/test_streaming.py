import datetime as dt

import pytest

from churnkit.operators.payload import unpack_payload
from churnkit.session import scratch_path
from churnkit.streaming import jobs
from tests.test_monitor import _drift
from tests.test_payload import FE, _raw


def _path(spark, name):
    return scratch_path(spark, f"t-{name}")


def test_unpack_stream_equals_batch(spark):
    raw, src, out = _raw(spark), _path(spark, "raw"), _path(spark, "out")
    raw.write.parquet(src)
    stream = jobs.unpack_stream(jobs.stream_parquet(spark, src, raw.schema), FE)
    jobs.to_parquet(stream, out, _path(spark, "ck")).awaitTermination()
    got = spark.read.parquet(out).select("request_id", "position", "prediction")
    want = unpack_payload(raw, FE).select("request_id", "position", "prediction")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4


def test_profile_stream_emits_closed_windows_and_drops_late_rows(spark):
    src, out = _path(spark, "log"), _path(spark, "prof")
    schema = "ts timestamp, v double, model_version string"
    first = [(dt.datetime(2024, 1, 1, 3), 1.0, "m"), (dt.datetime(2024, 1, 1, 9), None, "m"), (dt.datetime(2024, 1, 2, 5), 9.0, "m")]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(src)
    stream = lambda: jobs.profile_stream(jobs.stream_parquet(
        spark, src, spark.createDataFrame([], schema).schema), ["v"], "ts")
    ck = _path(spark, "ck")
    jobs.to_parquet(stream(), out, ck).awaitTermination()
    late = [(dt.datetime(2024, 1, 1, 4), 50.0, "m"), (dt.datetime(2024, 1, 3, 5), 2.0, "m")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    jobs.to_parquet(stream(), out, ck).awaitTermination()
    got = {r.window_start.day: (r.rows, r.v_nulls, r.v_mean) for r in spark.read.parquet(out).collect()}
    assert got == {1: (2, 1, 1.0), 2: (1, 0, 9.0)}


@pytest.mark.parametrize("every", [1, 2, 5])
def test_sync_stream_over_several_batches(spark, every):
    ddl = "k int, v string"
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], ddl)
    src, root, ck = _path(spark, "chg"), _path(spark, "root"), _path(spark, "ck")
    cddl = ddl + ", _change_type string, seq int"
    batches = [[(1, "a1", "update", 1), (1, "a2", "update", 2), (4, "d", "insert", 3)],
               [(1, "a3", "update", 4), (4, "d", "delete", 5), (2, "b", "delete", 6)]]
    for rows in batches:
        chg = spark.createDataFrame(rows, cddl)
        chg.coalesce(1).write.mode("append").parquet(src)
        jobs.sync_stream(jobs.stream_parquet(spark, src, chg.schema), base, ["k"], ["seq"], root, ck, every).awaitTermination()
    got = jobs.replica(base, root, chg.schema, ["k"], ["seq"])
    assert sorted(map(tuple, got.select("k", "v").collect())) == [(1, "a3"), (3, "c")]


def test_gate_stream_judges_each_arrival(spark):
    src, hist, dec, ck = (_path(spark, n) for n in ("drift", "hist", "dec", "ck"))
    for day, js in ((2, 0.1), (3, 0.6)):
        rows = _drift(spark, [("prediction", "CONSECUTIVE", day, "all", js)])
        rows.coalesce(1).write.mode("append").parquet(src)
        jobs.gate_stream(jobs.stream_parquet(spark, src, rows.schema), hist, dec, 0.2, ck).awaitTermination()
    got = [r.retrain_needed for r in spark.read.parquet(dec).orderBy("batch_id").collect()]
    assert got == [False, True]
