"""Profiling and exploratory analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import profile as P
from churnkit.operators.order import exact_quantiles
from churnkit.plans import data as D
from churnkit.plans.registry import query, table

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_TEXT = ["l_returnflag", "l_linestatus", "l_shipdate"]


def _rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("""SELECT o_orderpriority, count(*) AS n, round(avg((o_orderstatus = 'F')::INT), 4) AS rate,
                 round(avg(o_totalprice), 2) AS avg_o_totalprice FROM orders GROUP BY 1""")
def a4_rate_by(spark, d):
    o = table(spark, d, "orders").withColumn("finished", (F.col("o_orderstatus") == "F").cast("int"))
    return P.rate_by(o, "o_orderpriority", "finished", ["o_totalprice"])


@query("""SELECT o_orderstatus, count(*) AS n, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q1,
  round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS q3,
  max(o_totalprice) AS max FROM orders GROUP BY 1""")
def a5_five_num(spark, d):
    return _rounded(P.five_num(table(spark, d, "orders"), "o_orderstatus", "o_totalprice"), "q1", "median", "q3")


def _describe_sql():
    one = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS stddev,
      min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
      round(quantile_cont({c}, 0.75), 4) AS p75, max({c})::DOUBLE AS max, NULL::VARCHAR AS first_text,
      NULL::VARCHAR AS last_text FROM lineitem"""
    text = """SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, min({c})::VARCHAR, max({c})::VARCHAR FROM lineitem"""
    return " UNION ALL ".join([*(one.format(c=c) for c in _KEYS + _NUM), *(text.format(c=c) for c in _TEXT)])


@query(_describe_sql())
def a6_describe(spark, d):
    return _rounded(P.describe(table(spark, d, "lineitem"), approx=False), "mean", "stddev", "p25", "p50", "p75")


_RISK_NULLS = f"""WITH {D.RISK}, j AS (SELECT c_custkey, c_acctbal, attrition_risk_score, balance_outflow_30d_usd
  FROM customer LEFT JOIN latest ON c_custkey = customer_id)"""


@query(_RISK_NULLS + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls FROM j"""
    for c in ["c_custkey", "c_acctbal", "attrition_risk_score", "balance_outflow_30d_usd"]))
def a7_null_counts(spark, d):
    """Nulls per column of customers joined to their risk, which most of them lack."""
    from churnkit.plans.columns import _risk_left
    return P.null_counts(_risk_left(spark, d).select("c_custkey", "c_acctbal", "attrition_risk_score",
                                                     "balance_outflow_30d_usd"))


@query("""SELECT sum(n)::BIGINT AS total_rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT AS duplicate_rows FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""")
def a8_duplicate_count(spark, d):
    return P.duplicate_count(table(spark, d, "lineitem"))


@query("""SELECT t AS data_type, c::BIGINT AS n_columns, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES ('bigint', 2),
  ('string', 2), ('double', 1), ('timestamp_ntz', 1)) v(t, c)""")
def a9_shape(spark, d):
    return P.shape(table(spark, d, "orders"))


@query("""SELECT quality, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 2) AS pct
          FROM labels GROUP BY 1""")
def a10_class_balance(spark, d):
    return P.class_balance(table(spark, d, "labels"), "quality")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {p}::DOUBLE AS prob, quantile_disc({c}, {p}) AS value FROM lineitem"""
    for c in ["l_quantity", "l_extendedprice"] for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
def a11_quantiles(spark, d):
    """Exact elements of the data at five ranks."""
    return exact_quantiles(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"],
                           [0.05, 0.25, 0.5, 0.75, 0.95], method="discrete")


@query(" UNION ALL ".join(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"""
                          for a in _NUM for b in _NUM))
def a12_corr_matrix(spark, d):
    return _rounded(P.corr_matrix(table(spark, d, "lineitem"), _NUM), "corr", digits=6)


@query("SELECT *, abs(corr) AS strength, CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS direction FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, (l_returnflag = 'R')::INT), 6) AS corr FROM lineitem"
                            for c in _NUM) + ")")
def a13_target_corr(spark, d):
    li = table(spark, d, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return _rounded(P.target_corr(li, _NUM, "returned"), "corr", "strength", digits=6)


@query("SELECT *, CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS direction FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_NUM) for b in _NUM[i + 1:]) + ") ORDER BY abs(corr) DESC LIMIT 3")
def a14_top_pairs(spark, d):
    return _rounded(P.top_pairs(table(spark, d, "lineitem"), _NUM, 3), "corr", digits=6)


def _iqr_sql():
    one = """SELECT '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
      round(q1 - k * (q3 - q1), 4) AS lower, round(q3 + k * (q3 - q1), 4) AS upper,
      count(*) FILTER (v < q1 - k * (q3 - q1) OR v > q3 + k * (q3 - q1)) AS outliers,
      round(count(*) FILTER (v < q1 - k * (q3 - q1) OR v > q3 + k * (q3 - q1)) * 100.0::DOUBLE / count(*), 4) AS outlier_pct
      FROM (SELECT {c} AS v, 0.5::DOUBLE AS k FROM {t}), (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
      FROM {t}) GROUP BY q1, q3, k"""
    return " UNION ALL ".join(one.format(c=c, t="lineitem") for c in _NUM)


@query(_iqr_sql())
def a15_iqr_outliers(spark, d):
    """Fences at half the quartile distance, so that evenly spread columns have rows outside."""
    return _rounded(P.iqr_outliers(table(spark, d, "lineitem"), _NUM, k=0.5), "q1", "q3", "iqr", "lower", "upper",
                    "outlier_pct")


@query("""
WITH q AS (SELECT quantile_cont(o_totalprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM orders),
b AS (SELECT ((e[2] < o_totalprice)::INT + (e[3] < o_totalprice)::INT + (e[4] < o_totalprice)::INT
             + (e[5] < o_totalprice)::INT)::INT AS bin, e, (o_orderstatus = 'F')::INT AS y
      FROM orders, q)
SELECT bin, round(e[bin + 1], 2) AS lower, round(e[bin + 2], 2) AS upper, count(*) AS n, round(avg(y), 6) AS rate
FROM b GROUP BY bin, e""")
def a16_rate_by_bin(spark, d):
    o = table(spark, d, "orders").select("o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    out = P.rate_by_bin(o, "o_totalprice", "y", 5)
    return _rounded(_rounded(out, "lower", "upper", digits=2), "rate", digits=6)


@query(""" UNION ALL """.join(f"""
SELECT l_returnflag, '{c}' AS "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, count(*) AS n,
  min(v) FILTER (ok) AS whisker_low, max(v) FILTER (ok) AS whisker_high, count(*) FILTER (NOT ok) AS outliers
FROM (SELECT l_returnflag, {c} AS v, q1, median, q3, {c} >= q1 - 0.5::DOUBLE * (q3 - q1) AND {c} <= q3 + 0.5::DOUBLE * (q3 - q1) AS ok
  FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                             quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag))
GROUP BY l_returnflag, q1, median, q3""" for c in ["l_quantity", "l_extendedprice"]))
def a17_box_stats(spark, d):
    b = P.box_stats(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag", k=0.5)
    return _rounded(b, "q1", "median", "q3")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", round(avg({c}) FILTER (l_returnflag = 'R'), 4) AS mean_returned,
  round(avg({c}) FILTER (l_returnflag <> 'R'), 4) AS mean_kept FROM lineitem""" for c in _NUM))
def a18_compare_means(spark, d):
    li = table(spark, d, "lineitem")
    a, b = li.filter("l_returnflag = 'R'"), li.filter("l_returnflag <> 'R'")
    return _rounded(P.compare_means(a, b, _NUM, ("returned", "kept")), "mean_returned", "mean_kept")


def _rounds(spark, d):
    """Events as served records: day as round, user as batch; an error event is a failed batch."""
    return table(spark, d, "events").select(
        F.to_date("ts").cast("string").alias("round"), F.col("event_type").alias("cohort"), F.col("user_id").alias("batch"),
        (F.col("value") > 40).cast("int").alias("prediction"), (F.col("value") < 95).alias("ok"))


@query("""
WITH b AS (SELECT ts::DATE::VARCHAR AS round, event_type, user_id, count(*) FILTER (value < 95) AS n,
             count(*) FILTER (value < 95 AND value > 40) AS pos, max((value >= 95)::INT) AS bad FROM events GROUP BY 1, 2, 3)
SELECT round, CASE WHEN grouping(round) = 1 THEN 'overall' ELSE 'round' END AS scope, sum(n)::BIGINT AS predictions,
  sum(pos)::BIGINT AS positives, round(sum(pos)::DOUBLE / sum(n), 6) AS positive_rate, count(*) AS batches,
  sum(bad)::BIGINT AS errors FROM b GROUP BY ROLLUP (round)""")
def a19_round_summary(spark, d):
    return _rounded(P.round_summary(_rounds(spark, d)), "positive_rate", digits=6)


@query(f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {D.u(42, 'o_orderkey')}, o_orderkey LIMIT 1000")
def a20_sample_n(spark, d):
    """The same 1000 orders on every run."""
    return P.sample_n(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000, 42)


@query("""
SELECT CASE WHEN grouping(o_orderstatus) = 0 THEN 'o_orderstatus' WHEN grouping(o_orderpriority) = 0 THEN 'o_orderpriority'
  END AS slice_key, coalesce(o_orderstatus, o_orderpriority) AS slice_value, count(*) AS n,
  round(avg(o_totalprice), 4) AS avg_price FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority))""")
def a21_sliced_agg(spark, d):
    return P.sliced_agg(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"],
                        {"n": F.count("*"), "avg_price": F.round(F.avg("o_totalprice"), 4)})
