import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from churnkit.operators import payload as P

FE = ["a", "b"]


def _req(*recs):
    return json.dumps({"dataframe_records": list(recs)})


def _resp(*preds):
    return json.dumps({"predictions": list(preds)})


LOG = [
    ("ok", _req({"a": 1, "b": 2.5, "customer_id": "c1"}, {"a": 3, "b": None, "customer_id": "c2"}), _resp(1, 0.0), 200),
    ("failed", _req({"a": 1, "b": 1}), _resp(1), 500),
    ("broken", "{not json", _resp(1), 200),
    ("broken2", _req({"a": 1, "b": 1}), "oops", 200),
    ("empty", _req(), _resp(), 200),
    ("short", _req({"a": 5, "b": 5}, {"a": 6, "b": 6, "customer_id": "c6"}), _resp(1), 200),
    ("keyonly", _req({"customer_id": "c9"}), _resp(1), 200),
    ("null", None, None, 200),
]


def _raw(spark, rows=LOG):
    return spark.createDataFrame([(*r, dt.datetime(2024, 1, 1, 12)) for r in rows],
                                 "request_id string, request string, response string, status_code int, request_time timestamp")


def test_unpack(spark):
    got = {(r.request_id, r.position): (r.customer_id, r.a, r.b, r.prediction, r.model_version)
           for r in P.unpack_payload(_raw(spark), FE).collect()}
    assert got == {
        ("ok", 0): ("c1", 1.0, 2.5, 1.0, "served"), ("ok", 1): ("c2", 3.0, None, 0.0, "served"),
        ("short", 0): ("unknown", 5.0, 5.0, 1.0, "served"), ("short", 1): ("c6", 6.0, 6.0, None, "served")}


def test_unpack_keeps_a_version_and_takes_an_empty_log(spark):
    raw = _raw(spark).withColumn("model_version", F.lit("v7"))
    assert {r.model_version for r in P.unpack_payload(raw, FE).collect()} == {"v7"}
    assert P.unpack_payload(_raw(spark).limit(0), FE).count() == 0


def test_event_time_variants(spark):
    raw = _raw(spark)
    assert P.unpack_payload(raw, FE).first().inference_timestamp == dt.datetime(2024, 1, 1, 12)
    ms = raw.drop("request_time").withColumn("timestamp_ms", F.lit(1704110400123))
    assert P.unpack_payload(ms, FE).first().inference_timestamp == dt.datetime(2024, 1, 1, 12, 0, 0, 123000)
    none = raw.drop("request_time")
    at = F.lit("2020-02-02").cast("timestamp")
    assert P.unpack_payload(none, FE, now=at).first().inference_timestamp == dt.datetime(2020, 2, 2)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_pack_then_unpack_is_identity(spark, size):
    rows = [(f"c{i:03d}", float(i), None if i % 4 == 0 else i / 2, float(i % 2)) for i in range(50)]
    df = spark.createDataFrame(rows, "customer_id string, a double, b double, p double")
    batched = P.batch_rows(df, size, ["customer_id"])
    req, resp = P.pack_payload(batched, FE), P.pack_response(batched, "p")
    assert req.agg(F.max("n_records")).first()[0] == min(size, 50)
    log = req.join(resp, "batch").select(F.col("batch").cast("string").alias("request_id"), "request", "response",
                                         F.lit(200).alias("status_code"), F.lit(0).cast("long").alias("timestamp_ms"))
    got = sorted((r.customer_id, r.a, r.b, r.prediction) for r in P.unpack_payload(log, FE).collect())
    assert got == rows


def test_batches_have_exact_sizes(spark, shuffle_parts):
    df = spark.range(103).withColumn("v", F.col("id") % 10)
    run = lambda: P.batch_rows(df, 25, ["id"], order="v")
    sizes = [r["count"] for r in run().groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [25, 25, 25, 25, 3]
    runs = shuffle_parts(run)
    assert runs[0] == runs[1] == runs[2]
