"""Windows, profiles, drift, quality and retrain decisions over the inference log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators import evaluate as E
from churnkit.operators import monitor as M
from churnkit.operators import sketches as K
from churnkit.plans import data as D
from churnkit.plans.registry import query, table
from churnkit.session import kept_once, scratch_path
from churnkit.sources.tables import save

BINS = 10


def _start(df, column="window_start"):
    return df.withColumn(column, F.col(column).cast("string"))


def _total(mean, n):
    """The sum behind a mean of values with two digits, in cents: whole, so that no order of addition shows."""
    return F.round(mean * n * 100).cast("long")


def _flat(drift):
    """Drift rows with the window as text and the distance rounded."""
    return drift.select("column_name", "drift_type", F.col("window.start").cast("string").alias("window_start"),
                        "model_version", "slice_key", "slice_value", F.round("js_distance", 6).alias("js_distance"))


def edges(spark, d):
    return M.numeric_edges(D.inference_log(spark, d), ["value"], BINS)


def dist(spark, d, slices=("event_type",)):
    """Bin shares per window, stored as a monitor stores its metric tables."""
    shares = M.distributions(D.inference_log(spark, d), "ts", edges(spark, d), ["prediction"], "model_version", slices)
    return save(shares, scratch_path(spark, "shares"))


_EDGES = f"edges AS (SELECT quantile_cont(value, [{', '.join(str(i / BINS) for i in range(BINS + 1))}]) AS e FROM events)"
_BIN = "(" + " + ".join(f"(e[{i}] < value)::INT" for i in range(2, BINS + 1)) + ")::VARCHAR"
_SLICES = "(SELECT 'all' AS slice_key, NULL AS by_type UNION ALL SELECT 'event_type', true) s"
_DIST = f"""{D.LOG}, {_EDGES},
cells AS (SELECT date_trunc('day', ts) AS w, model_version, slice_key, CASE WHEN by_type THEN event_type ELSE 'all' END AS slice_value,
    unnest([{{'c': 'value', 'b': {_BIN}}}, {{'c': 'prediction', 'b': prediction::VARCHAR}}]) AS x FROM ilog, edges, {_SLICES}),
dist AS (SELECT w, model_version, slice_key, slice_value, x.c AS column_name, x.b AS bin, count(*) AS n,
    count(*) / sum(count(*)) OVER (PARTITION BY w, model_version, slice_key, slice_value, x.c)::DOUBLE AS share
  FROM cells GROUP BY 1, 2, 3, 4, 5, 6)"""
_JS = """sqrt(greatest(0, least(1, (sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
  + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2)))"""
_CONSEC = f"""{_DIST},
wins AS (SELECT *, lag(w) OVER (PARTITION BY model_version, slice_key, slice_value, column_name ORDER BY w) AS pw
  FROM (SELECT DISTINCT model_version, slice_key, slice_value, column_name, w FROM dist)),
pq AS (SELECT model_version, slice_key, slice_value, column_name, w, bin, sum(p) AS p, sum(q) AS q FROM (
  SELECT wins.*, bin, share AS p, 0.0::DOUBLE AS q FROM wins JOIN dist USING (model_version, slice_key, slice_value, column_name, w)
  WHERE pw IS NOT NULL
  UNION ALL SELECT wins.*, bin, 0.0::DOUBLE, share FROM wins JOIN dist ON wins.model_version = dist.model_version
    AND wins.slice_key = dist.slice_key AND wins.slice_value = dist.slice_value AND wins.column_name = dist.column_name
    AND wins.pw = dist.w) GROUP BY ALL),
consec AS (SELECT column_name, 'CONSECUTIVE' AS drift_type, w, model_version, slice_key, slice_value, {_JS} AS js
  FROM pq GROUP BY ALL)"""
_ROW = """SELECT column_name, drift_type, w::VARCHAR AS window_start, model_version, slice_key, slice_value,
  round(js, 6) AS js_distance FROM """


@query("SELECT date_trunc('day', ts)::VARCHAR AS window_start, count(*) AS n, sum(round(value * 100))::BIGINT AS cents FROM events GROUP BY 1")
def m1_time_window(spark, d):
    w = M.time_window(D.inference_log(spark, d), "ts")
    return w.groupBy(F.col("window.start").cast("string").alias("window_start")).agg(
        F.count("*").alias("n"), _total(F.avg("value"), F.count("value")).alias("cents"))


@query(f"""WITH {D.LOG}, long AS (SELECT date_trunc('day', ts) AS w, model_version, slice_key,
    CASE WHEN by_type THEN event_type ELSE 'all' END AS slice_value,
    unnest([{{'c': 'value', 'v': value}}, {{'c': 'prediction', 'v': prediction::DOUBLE}}]) AS x FROM ilog, {_SLICES})
  SELECT w::VARCHAR AS window_start, model_version, slice_key, slice_value, x.c AS column_name, count(*) AS count,
    count(*) FILTER (x.v IS NULL) AS nulls, sum(round(x.v * 100))::BIGINT AS cents, round(stddev(x.v), 6) AS stddev, min(x.v) AS min,
    max(x.v) AS max, count(DISTINCT x.v) AS distinct_count, round(quantile_cont(x.v, 0.25), 4) AS p25,
    round(quantile_cont(x.v, 0.5), 4) AS p50, round(quantile_cont(x.v, 0.75), 4) AS p75 FROM long GROUP BY 1, 2, 3, 4, 5""")
def m2_profile_metrics(spark, d):
    out = M.profile_metrics(D.inference_log(spark, d), ["value", "prediction"], "ts", slices=["event_type"],
                            quantiles={"p25": 0.25, "p50": 0.5, "p75": 0.75}, exact=True)
    out = out.withColumns({c: F.round(c, 4) for c in ("p25", "p50", "p75")})
    out = out.withColumns({"cents": _total(F.col("mean"), F.col("count") - F.col("nulls")), "stddev": F.round("stddev", 6)})
    return _start(out.drop("mean"))


_GAMMA = "(1.01::DOUBLE / 0.99)"
_BUCKET = f"CASE WHEN value = 0 THEN 0 ELSE sign(value) * (ceil(ln(abs(value)) / ln({_GAMMA})) + 1000000) END"


def _rank_value(p):
    at = f"list(b ORDER BY b)[greatest(1, ceil(count(b) * {p}))::BIGINT]"
    return f"round(CASE WHEN {at} = 0 THEN 0 ELSE sign({at}) * pow({_GAMMA}, abs({at}) - 1000000) * 2 / ({_GAMMA} + 1) END, 6)"


@query(f"""WITH {D.LOG}, long AS (SELECT date_trunc('week', ts) AS w, model_version, value, {_BUCKET} AS b FROM ilog)
  SELECT w::VARCHAR AS window_start, model_version, count(*) AS count, count(*) FILTER (value IS NULL) AS nulls, min(value) AS min,
    max(value) AS max, {_rank_value(0.25)} AS p25, {_rank_value(0.5)} AS p50, {_rank_value(0.95)} AS p95,
    count(DISTINCT value) AS distinct_count, true AS distinct_near FROM long GROUP BY 1, 2""")
def m2_sketch_roll_up(spark, d):
    """Weeks from the stored sketches of days and event types. The distinct count is exact; the estimate from the sketches
    lies within four standard errors of it."""
    log = D.inference_log(spark, d)
    days = kept_once(K.profile_sketches(log, ["value"], "ts", slices=["event_type"]), "sketches")
    parts = days.filter("slice_key = 'event_type'")
    week = F.date_trunc("week", "window_start")
    weeks = K.roll_up(parts, {"window_start": week, "model_version": F.col("model_version")})
    est = weeks.select("window_start", "model_version", "count", "nulls", "min", "max", K.distinct_estimate().alias("about"),
                       *[F.round(K.quantile_estimate(p), 6).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p95", 0.95))])
    exact = log.groupBy(F.date_trunc("week", "ts").alias("window_start"), "model_version").agg(F.count_distinct("value").alias("distinct_count"))
    near = F.abs(F.col("about") - F.col("distinct_count")) <= 4 * 0.023 * F.col("distinct_count") + 0.5
    return _start(est.join(exact, ["window_start", "model_version"]).withColumn("distinct_near", near).drop("about"))


@query(f"""WITH {_DIST} SELECT w::VARCHAR AS window_start, model_version, slice_key, slice_value, column_name, bin, n,
           round(share, 6) AS share FROM dist""")
def m3_distributions(spark, d):
    return _start(dist(spark, d).withColumn("share", F.round("share", 6)))


@query(f"WITH {_CONSEC} {_ROW} consec")
def m4_drift_consecutive(spark, d):
    return _flat(M.drift_consecutive(dist(spark, d)))


_BASE = f"""base AS (SELECT x.c AS column_name, x.b AS bin, count(*) / sum(count(*)) OVER (PARTITION BY x.c)::DOUBLE AS share FROM (
    SELECT unnest([{{'c': 'value', 'b': {_BIN}}}, {{'c': 'prediction', 'b': prediction::VARCHAR}}]) AS x FROM ilog, edges
    WHERE event_type = 'purchase') GROUP BY 1, 2),
bq AS (SELECT model_version, slice_key, slice_value, column_name, w, bin, sum(p) AS p, sum(q) AS q FROM (
    SELECT model_version, slice_key, slice_value, column_name, w, bin, share AS p, 0.0::DOUBLE AS q FROM dist
    UNION ALL SELECT model_version, slice_key, slice_value, column_name, w, bin, 0.0::DOUBLE, share FROM (
      SELECT DISTINCT model_version, slice_key, slice_value, column_name, w FROM dist) JOIN base USING (column_name)) GROUP BY ALL),
basejs AS (SELECT column_name, 'BASELINE' AS drift_type, w, model_version, slice_key, slice_value, {_JS} AS js FROM bq GROUP BY ALL)"""


def _baseline(spark, d, shares=None):
    log = D.inference_log(spark, d)
    e = edges(spark, d)
    base = M.baseline_shares(log.filter("event_type = 'purchase'"), e, ["prediction"])
    return M.drift_baseline(shares if shares is not None else dist(spark, d), base)


@query(f"WITH {_DIST}, {_BASE} {_ROW} basejs")
def m5_drift_baseline(spark, d):
    """Each window against the shares of the purchases."""
    return _flat(_baseline(spark, d))


@query(f"WITH {_CONSEC} {_ROW} consec WHERE column_name = 'prediction'")
def m6_prediction_drift(spark, d):
    return _flat(M.drift_view(M.drift_consecutive(dist(spark, d)), ["prediction"]))


_Q_LOG = "qlog AS (SELECT ts, user_id, CASE WHEN value <= 90 OR event_type <> 'error' THEN value END AS value FROM events)"


@query(f"""WITH {_Q_LOG}, win AS (SELECT date_trunc('day', ts) AS w, count(*) AS rows, count(*) FILTER (value IS NULL) AS value,
    count(*) FILTER (user_id IS NULL) AS user_id FROM qlog GROUP BY 1),
  long AS (SELECT w, rows, 'value' AS column_name, value AS nulls FROM win UNION ALL SELECT w, rows, 'user_id', user_id FROM win),
  st AS (SELECT *, nulls / rows AS null_rate, (rows - avg(rows) OVER p) / nullif(stddev(rows) OVER p, 0) AS z FROM long
    WINDOW p AS (PARTITION BY column_name ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT w::VARCHAR AS window_start, rows, column_name, nulls, round(null_rate, 6) AS null_rate,
    round(null_rate - lag(null_rate) OVER (PARTITION BY column_name ORDER BY w), 6) AS null_rate_change,
    round(z, 4) AS volume_z, coalesce(abs(z) > 3, false) AS volume_anomaly,
    CASE column_name WHEN 'user_id' THEN 'int -> bigint' END AS schema_change FROM st
  UNION ALL SELECT NULL, NULL, c, NULL, NULL, NULL, NULL, false, n FROM (VALUES ('region', 'missing'), ('ts', 'added')) v(c, n)""")
def m7_quality_checks(spark, d):
    """A log in which some values are missing, held against a schema that lacks one of its columns, has one more and another type."""
    log = table(spark, d, "events").select("ts", "user_id", F.when(
        (F.col("value") <= 90) | (F.col("event_type") != "error"), F.col("value")).alias("value"))
    expected = T.StructType.fromDDL("user_id int, value double, region string")
    out = M.quality_checks(log, ["value", "user_id"], "ts", expected=expected)
    return _start(out.withColumns({"null_rate": F.round("null_rate", 6), "volume_z": F.round("volume_z", 4),
                                   "null_rate_change": F.round("null_rate_change", 6)}))


@query(f"""WITH {D.LOG} SELECT date_trunc('day', ts)::VARCHAR AS window_start, slice_key,
  CASE WHEN by_type THEN event_type ELSE 'all' END AS slice_value, 'flagged_value' AS metric,
  sum(value::DECIMAL(18,2)) FILTER (prediction = 1)::DOUBLE AS value FROM ilog, {_SLICES} GROUP BY 1, 2, 3""")
def m8_custom_metric(spark, d):
    out = M.custom_metric(D.inference_log(spark, d), "flagged_value", "sum(CASE WHEN prediction = 1 THEN cast(value AS DECIMAL(18,2)) END)", "ts",
                          ["event_type"])
    return _start(out)


_GATE = """gate AS (SELECT drift_type, w, js FROM consec WHERE column_name = 'prediction' AND slice_key = 'all'
  ORDER BY w DESC, js DESC LIMIT 1)"""
_GATE_ROW = """SELECT js >= 0.05 AS retrain_needed, drift_type, w::VARCHAR AS window_start, round(js, 6) AS js_distance,
  'prediction: CONSECUTIVE distance ' || printf('%.4f', js) || CASE WHEN js >= 0.05 THEN ' reaches ' ELSE ' stays below ' END || '0.05' AS reason FROM gate"""


def gate_rows(spark, d):
    """Consecutive and baseline drift rows, as the monitor stores them."""
    shares = kept_once(dist(spark, d, ()), "shares")
    return M.drift_consecutive(shares).unionByName(_baseline(spark, d, shares))


def _gate(spark, d):
    return M.drift_gate(gate_rows(spark, d), 0.05)


@query(f"WITH {_CONSEC}, {_GATE} {_GATE_ROW}")
def m9_drift_gate(spark, d):
    return _start(_gate(spark, d).withColumn("js_distance", F.round("js_distance", 6)))


def _decision_sql():
    from churnkit.plans.evaluation import _BOARD
    return f"""WITH {_CONSEC}, {_GATE}, {_BOARD}, gr AS ({_GATE_ROW})
  SELECT 'churn' AS model, b.model AS version, retrain_needed, round(test_f1, 4) >= 0.40 AS approved,
    CASE WHEN NOT retrain_needed THEN 'keep' WHEN round(test_f1, 4) >= 0.40 THEN 'promote' ELSE 'reject' END AS action FROM gr, board b"""


@query(_decision_sql())
def m10_retrain_decision(spark, d):
    """Drift gate joined with the approval of each candidate."""
    from churnkit.plans.evaluation import _metrics
    out = M.retrain_decision(_gate(spark, d), E.approve(_metrics(spark, d)), "churn")
    return out.drop("gate_reason", "approval_reason")


@query("""WITH s AS (SELECT event_type, date_trunc('day', ts) AS w, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total
    FROM events GROUP BY 1, 2)
  SELECT event_type, w::VARCHAR AS window_start, n, lag(n) OVER p AS prev_n, n - lag(n) OVER p AS n_change
  FROM s WINDOW p AS (PARTITION BY event_type ORDER BY w)""")
def w4_window_change(spark, d):
    """Volume of each day against the day before."""
    per = D.inference_log(spark, d).groupBy("event_type", F.window("ts", "1 day")["start"].alias("window_start")).agg(
        F.count("*").alias("n"))
    return _start(M.window_change(per, ["event_type"], "window_start", ["n"]))
