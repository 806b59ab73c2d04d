"""Streaming forms, each run until its input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators.features import FEATURES
from churnkit.plans import monitoring as MO
from churnkit.plans import requests as R
from churnkit.plans import storage as S
from churnkit.plans.registry import SQL, query, table
from churnkit.session import scratch_path
from churnkit.sources.sync import change_feed
from churnkit.streaming import drift, jobs


def _run(q):
    q.awaitTermination()


@query(SQL["x3_unpack_payload"])
def st1_unpack_stream(spark, d):
    """The request log unpacked as it arrives."""
    src, out = scratch_path(spark, "requests"), scratch_path(spark, "unpacked")
    log = R.request_log(spark, d)
    log.write.parquet(src)
    stream = jobs.unpack_stream(jobs.stream_parquet(spark, src, log.schema), FEATURES)
    _run(jobs.to_parquet(stream, out, scratch_path(spark, "ckpt")))
    got = spark.read.schema(stream.schema).parquet(out)
    return got.withColumn("inference_time", F.col("inference_timestamp").cast("string")).drop("inference_timestamp")


@query("""SELECT date_trunc('day', ts)::VARCHAR AS window_start, (user_id % 2)::VARCHAR AS model_version, slice_key,
  CASE WHEN by_type THEN event_type ELSE 'all' END AS slice_value, count(*) AS rows, count(*) FILTER (value IS NULL) AS value_nulls,
  sum(round(value * 100))::BIGINT AS value_cents, round(stddev(value), 6) AS value_stddev, min(value) AS value_min, max(value) AS value_max
  FROM events, (SELECT 'all' AS slice_key, NULL AS by_type UNION ALL SELECT 'event_type', true) s GROUP BY 1, 2, 3, 4
  HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def st2_profile_stream(spark, d):
    """Daily profile of the log, whole and by event type; the last, still open day is held back."""
    events = table(spark, d, "events")
    stream = jobs.stream_parquet(spark, d, events.schema, only="events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "value", "event_type", (F.col("user_id") % 2).cast("string").alias("model_version"))
    prof, out = jobs.profile_stream(stream, ["value"], "ts", slices=["event_type"]), scratch_path(spark, "profile")
    _run(jobs.to_parquet(prof, out, scratch_path(spark, "ckpt")))
    got = spark.read.schema(prof.schema).parquet(out)
    known = F.col("rows") - F.col("value_nulls")
    return got.withColumns({"window_start": F.col("window_start").cast("string"), "value_stddev": F.round("value_stddev", 6),
                            "value_cents": MO._total(F.col("value_mean"), known)}).drop("value_mean", "value_distinct", "value_median")


@query(SQL["s11_upsert"])
def st3_sync_stream(spark, d):
    """A replica of the older customer version brought up to date from a stream of changes."""
    old, new = S._versions(spark, d)
    src, root = scratch_path(spark, "changes"), scratch_path(spark, "synced")
    feed = change_feed(old, new, ["c_custkey"]).withColumn("seq", F.lit(1))
    feed.repartition(3, "c_custkey").write.parquet(src)
    stream = jobs.stream_parquet(spark, src, feed.schema, files_per_batch=1)
    _run(jobs.sync_stream(stream, old, ["c_custkey"], ["seq"], root, scratch_path(spark, "ckpt"), every=2))
    return jobs.replica(old, root, feed.schema, ["c_custkey"], ["seq"])


@query(SQL["m9_drift_gate"])
def st4_gate_stream(spark, d):
    """The drift gate judged again when drift rows land."""
    src, hist, dec = (scratch_path(spark, n) for n in ("drift", "history", "decisions"))
    rows = MO.gate_rows(spark, d)
    rows.write.parquet(src)
    _run(jobs.gate_stream(jobs.stream_parquet(spark, src, rows.schema), hist, dec, 0.05, scratch_path(spark, "ckpt")))
    got = spark.read.parquet(dec)
    newest = got.filter(F.col("batch_id") == got.agg(F.max("batch_id").alias("b")).scalar())
    return newest.select("retrain_needed", "drift_type", F.col("window_start").cast("string").alias("window_start"),
                         F.round("js_distance", 6).alias("js_distance"), "reason")


@query(f"""WITH {MO._CONSEC} {MO._ROW} consec WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def st5_drift_stream(spark, d):
    """Drift of each day against the day before in its series, as days close; the last, still open day is held back."""
    events, root = table(spark, d, "events"), scratch_path(spark, "followed")
    stream = jobs.stream_parquet(spark, d, events.schema, only="events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "value", "event_type", (F.col("value") > 40).cast("int").alias("prediction"),
        (F.col("user_id") % 2).cast("string").alias("model_version"))
    drift.follow_drift(stream, "ts", MO.edges(spark, d), root, categorical=["prediction"], version="model_version", slices=["event_type"])
    return MO._flat(spark.read.parquet(f"{root}/drift"))


@query(SQL["x3_first_deliveries"])
def st6_deliveries_stream(spark, d):
    """A log with retried requests unpacked as it arrives, each request once."""
    src, out = scratch_path(spark, "retried"), scratch_path(spark, "unpacked")
    log = R.retried_log(spark, d).withColumn("arrived", F.timestamp_millis("timestamp_ms"))
    log.write.parquet(src)
    once = jobs.deliveries_stream(jobs.stream_parquet(spark, src, log.schema), "arrived", late="1 hour")
    stream = jobs.unpack_stream(once.drop("arrived"), FEATURES)
    _run(jobs.to_parquet(stream, out, scratch_path(spark, "ckpt")))
    got = spark.read.schema(stream.schema).parquet(out)
    return got.withColumn("inference_time", F.col("inference_timestamp").cast("string")).drop("inference_timestamp")
