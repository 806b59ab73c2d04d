"""Classifier metrics, comparisons and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.functions import columns as C
from churnkit.operators import curves as CU
from churnkit.operators import evaluate as E
from churnkit.operators import model as M
from churnkit.operators.assemble import pair_with
from churnkit.plans import data as D
from churnkit.plans.registry import query, table


def _labels(spark, d):
    return table(spark, d, "labels").select("doc_id", F.col("quality").alias("y"), F.col("toxic").alias("yhat"))


def _round(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


_CELLS = """cm AS (SELECT count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 1 AND yhat = 1) AS tp FROM {src})"""
_LAB = "lab AS (SELECT doc_id, quality AS y, toxic AS yhat FROM labels)"
_LCM = f"WITH {_LAB}, {_CELLS.format(src='lab')}"
_SCM = f"WITH {D.SCORED}, {_CELLS.format(src='scored')}"
_F1P = "coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0)"
_F1N = "coalesce(2.0::DOUBLE * tn / nullif(2 * tn + fp + fn, 0), 0)"
_P1 = "coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)"
_R1 = "coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)"
_P0 = "coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0)"
_R0 = "coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)"


@query(f"{_LCM} SELECT * FROM cm")
def e1_confusion(spark, d):
    return E.confusion(_labels(spark, d), "y", "yhat")


@query(f"{_LCM} SELECT round({_P1}, 6) AS precision_pos, round({_R1}, 6) AS recall_pos FROM cm")
def e2_precision_recall(spark, d):
    return _round(E.pr_pos(_labels(spark, d), "y", "yhat"), "precision_pos", "recall_pos")


_CURVE = """g AS (SELECT score, sum(y)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM scored GROUP BY score),
cv AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn FROM g)"""
_AP = "sum(pos * cp / cn) / sum(pos)"
_AUC = "1 - sum(pos * ((cn - cp) - (n - pos) / 2)) / (sum(pos) * sum(n - pos))"


@query(f"WITH {D.SCORED}, {_CURVE} SELECT round({_AP}, 6) AS pr_auc FROM cv")
def e3_average_precision(spark, d):
    return _round(E.average_precision(D.scored_orders(spark, d), "y", "score"), "pr_auc")


@query(f"WITH {D.SCORED}, {_CURVE} SELECT round({_AUC}, 6) AS roc_auc FROM cv")
def e4_roc_auc(spark, d):
    return _round(E.roc_auc(D.scored_orders(spark, d), "y", "score"), "roc_auc")


_BINS = 512
_HIST = f"""h AS (SELECT least({_BINS - 1}, floor(greatest(0, least(1, score)) * {_BINS}))::INT AS bin, sum(y)::DOUBLE AS p, count(*)::DOUBLE AS n
  FROM scored GROUP BY 1),
hb AS (SELECT *, n - p AS m, coalesce(sum(p) OVER w, 0) AS bp, coalesce(sum(n) OVER w, 0) AS bn FROM h
  WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ends AS (SELECT sum(p) AS p, sum(m) AS m, sum(p * (bn - bp)) AS lost, sum(p * m) AS tied,
  sum(CASE WHEN p > 0 THEN p * ((bp + 1) / (bn + m + 1) + (bp + p) / (bn + m + p)) / 2 ELSE 0 END) AS least,
  sum(CASE WHEN p > 0 THEN p * (bp + p) / (bn + p) ELSE 0 END) AS most FROM hb)"""


@query(f"""WITH {D.SCORED}, {_HIST} SELECT round((least + most) / 2 / p, 6) AS pr_auc, round((most - least) / 2 / p, 6) AS pr_error,
  round(1 - (lost + tied / 2) / (p * m), 6) AS roc_auc, round(tied / 2 / (p * m), 6) AS roc_error, true AS bound_holds FROM ends""")
def e3_curve_sketch(spark, d):
    """Both areas from the score histograms of parts of the table, and whether the exact areas lie within the stated errors."""
    scored = D.scored_orders(spark, d)
    parts = CU.score_histogram(scored.withColumn("part", F.pmod(F.xxhash64("score"), F.lit(4))), "y", "score", ["part"], _BINS)
    got = CU.curve_areas(CU.add_histograms(parts))
    exact = {"pr": E.average_precision(scored, "y", "score").scalar(), "roc": E.roc_auc(scored, "y", "score").scalar()}
    slack = 1e-9
    holds = (F.abs(F.col("pr") - F.col("pr_auc")) <= F.col("pr_error") + slack) & (F.abs(F.col("roc") - F.col("roc_auc")) <= F.col("roc_error") + slack)
    return _round(got.withColumns(exact).withColumn("bound_holds", holds).drop("pr", "roc"), "pr_auc", "pr_error", "roc_auc", "roc_error")


@query(f"{_SCM} SELECT round(({_F1P} + {_F1N}) / 2, 6) AS macro_f1 FROM cm")
def e5_macro_f1(spark, d):
    return _round(E.macro_f1(D.scored_orders(spark, d), "y", "yhat"), "macro_f1")


@query(f"""WITH {D.SCORED} SELECT o_orderstatus, count(*) AS n, count(*) FILTER (y <> yhat) AS incorrect,
           round(avg((y = yhat)::INT), 6) AS accuracy FROM scored GROUP BY 1""")
def e6_accuracy(spark, d):
    return _round(E.accuracy(D.scored_orders(spark, d), "y", "yhat", ["o_orderstatus"]), "accuracy")


@query(f"""{_SCM}, r AS (SELECT {_P0} AS p0, {_R0} AS r0, {_F1N} AS f0, tn + fp AS s0, {_P1} AS p1, {_R1} AS r1, {_F1P} AS f1,
  tp + fn AS s1 FROM cm)
  SELECT "class", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM (
  SELECT 'Retained' AS "class", p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM r UNION ALL SELECT 'Churned', p1, r1, f1, s1 FROM r
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM r
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
  (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM r)""")
def e7_class_report(spark, d):
    rep = E.class_report(D.scored_orders(spark, d), "y", "yhat", {0: "Retained", 1: "Churned"})
    return _round(rep, "precision", "recall", "f1")


@query(f"""WITH {D.SCORED} SELECT o_orderkey, o_totalprice, y AS actual_churned, yhat AS predicted_churned, y = yhat AS correct
           FROM scored JOIN (SELECT o_orderkey, o_totalprice FROM orders) USING (o_orderkey)""")
def e8_eval_log(spark, d):
    s = D.scored_orders(spark, d)
    preds = table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(
        s.select("o_orderkey", F.col("yhat").alias("prediction")), "o_orderkey")
    return E.eval_log(s, preds, "o_orderkey", ["o_totalprice"], "y")


@query(f"""WITH {_LAB} SELECT k::INT AS "class", round(avg((y = k)::INT) * 100, 6) AS actual_pct,
           round(avg((yhat = k)::INT) * 100, 6) AS predicted_pct FROM lab, range(2) c(k) GROUP BY k""")
def e9_share_shift(spark, d):
    return _round(E.share_shift(_labels(spark, d), "y", "yhat"), "actual_pct", "predicted_pct")


def _two_models(spark, d):
    """Two models' scores on the same orders, one long table."""
    base = pair_with(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), ["forest", "boosted"], "model")
    y = F.col("o_orderpriority").isin(*D.TERM_PRODUCTS).cast("int")
    lift = F.when(F.col("model") == "forest", F.lit(0.3)).otherwise(F.lit(0.4))
    raw = (F.lit(1.0) - lift) * C.hash_uniform(7, "model", "o_orderkey") + lift * y
    return base.select("model", "o_orderkey", y.alias("y"), raw.alias("score")).withColumn(
        "yhat", M.apply_threshold("score"))


_TWO = f"""two AS (SELECT *, (score >= 0.5::DOUBLE)::INT AS yhat FROM (
  SELECT model, o_orderkey, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS y,
  (1.0::DOUBLE - lift) * {D.u(7, "model || '|' || o_orderkey")} + lift * (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS score
  FROM orders, (VALUES ('forest', 0.3::DOUBLE), ('boosted', 0.4::DOUBLE)) m(model, lift)))"""
_BOARD = f"""{_TWO}, g AS (SELECT model, score, sum(y)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM two GROUP BY 1, 2),
cv AS (SELECT *, sum(pos) OVER w AS cp, sum(n) OVER w AS cn FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
rk AS (SELECT model, {_AP} AS pr_auc, {_AUC} AS roc_auc FROM cv GROUP BY 1),
cm AS (SELECT model, count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 1 AND yhat = 1) AS tp FROM two GROUP BY 1),
board AS (SELECT model, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, round({_R1}, 6) AS recall_pos,
  round({_P1}, 6) AS precision_pos, round(({_F1P} + {_F1N}) / 2, 6) AS test_f1,
  round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy FROM rk JOIN cm USING (model))"""
_BOARD_COLS = ["pr_auc", "roc_auc", "recall_pos", "precision_pos", "test_f1", "accuracy"]


def _board(spark, d):
    return _round(E.leaderboard(_two_models(spark, d), "model", "y", "score", "yhat"), *_BOARD_COLS)


@query(f"WITH {_BOARD} SELECT * FROM board")
def e10_leaderboard(spark, d):
    return _board(spark, d)


@query(f"""WITH {_TWO} SELECT count(*) AS compared, count(*) FILTER (a.yhat = b.yhat) AS identical,
  round(avg((a.yhat = b.yhat)::INT) * 100, 4) AS identical_pct
  FROM two a JOIN two b USING (o_orderkey) WHERE a.model = 'forest' AND b.model = 'boosted'""")
def e11_parity(spark, d):
    t = _two_models(spark, d)
    return E.parity(t.filter("model = 'forest'"), t.filter("model = 'boosted'"), "o_orderkey", "yhat")


@query(f"""WITH {_TWO} SELECT o_orderkey, a.yhat AS prediction_a, b.yhat AS prediction_b
  FROM two a JOIN two b USING (o_orderkey) WHERE a.model = 'forest' AND b.model = 'boosted' AND a.yhat <> b.yhat""")
def j9_parity_diff(spark, d):
    """The keyed predictions on which two models differ."""
    t = _two_models(spark, d)
    return E.parity_diff(t.filter("model = 'forest'"), t.filter("model = 'boosted'"), "o_orderkey", "yhat")


_LONG = " UNION ALL ".join(f"SELECT model AS version, '{m}' AS metric, round({m}, 4) AS value FROM board"
                           for m in ("pr_auc", "test_f1", "accuracy"))


def _metrics(spark, d):
    return E.metrics_long(_board(spark, d), F.col("model"), ["pr_auc", "test_f1", "accuracy"])


@query(f"WITH {_BOARD} {_LONG}")
def e12_metrics_long(spark, d):
    return _metrics(spark, d)


@query(f"""WITH {_BOARD}, ml AS ({_LONG}) SELECT version, 'test_f1' AS metric, value, t::DOUBLE AS threshold, value >= t AS approved,
  'test_f1 of ' || printf('%.4f', value) || CASE WHEN value >= t THEN ' meets ' ELSE ' misses ' END || printf('%.2f', t) AS reason
  FROM ml, (VALUES (0.4::DOUBLE), (0.62::DOUBLE)) l(t) WHERE metric = 'test_f1'""")
def e13_approve(spark, d):
    """Each version against the usual threshold and against a stricter one."""
    return E.approve(_metrics(spark, d)).unionByName(E.approve(_metrics(spark, d), 0.62))


@query(f"""WITH {_BOARD} SELECT model, 'dev' AS alias, 3 AS version, pr_auc FROM board WHERE model = 'forest'""")
def e14_resolve_version(spark, d):
    """Version to score with: there is no champion, so the newest dev version."""
    forest = F.col("model") == "forest"
    versions = _board(spark, d).select("model", F.when(forest, "dev").otherwise("retired").alias("alias"),
                                       F.when(forest, 3).otherwise(4).alias("version"), "pr_auc")
    return E.resolve_version(versions)


@query(f"""WITH {D.SCORED} SELECT o_orderkey, score AS probability, (score >= 0.325::DOUBLE)::INT AS prediction FROM scored""")
def f10_apply_threshold(spark, d):
    s = D.scored_orders(spark, d)
    return s.select("o_orderkey", F.col("score").alias("probability"),
                    M.apply_threshold("score", M.IMPORTED_THRESHOLD).alias("prediction"))


@query(f"""WITH {D.SCORED} SELECT o_orderkey, score, yhat AS prediction, '2024-01-31 00:00:00' AS inference_time, '7' AS model_version
           FROM scored""")
def f13_inference_log(spark, d):
    s = D.scored_orders(spark, d).select("o_orderkey", "score", F.col("yhat").alias("prediction"))
    log = M.to_inference_log(s, "7", F.lit("2024-01-31 00:00:00"))
    return log.withColumn("inference_time", F.col("inference_timestamp").cast("string")).drop("inference_timestamp")


@query(f"""WITH {D.SCORED} SELECT o_orderkey, o_orderstatus, round(score, 6) AS churn_probability,
  (score >= 0.325::DOUBLE)::INT AS predicted_churn, y AS actual_churn, (score >= 0.325::DOUBLE)::INT = y AS correct,
  '2024-01-31 00:00:00' AS scored_time FROM scored""")
def f14_scored_table(spark, d):
    s = D.scored_orders(spark, d)
    out = M.scored_table(s, ["o_orderkey", "o_orderstatus"], "y", F.lit("2024-01-31 00:00:00"), "score")
    return out.withColumn("scored_time", F.col("scored_at").cast("string")).drop("scored_at")
