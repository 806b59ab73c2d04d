"""Derived columns, projections, filters and scalar logic."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.functions import columns as C
from churnkit.operators import assemble as A
from churnkit.operators import features as FT
from churnkit.operators.order import draw_rank
from churnkit.plans import data as D
from churnkit.plans.registry import query, table

_KEY = "o_orderkey"


@query(f"SELECT c_custkey, round({D.u(42, 'c_custkey')}, 9) AS u FROM customer")
def g1_hash_uniform(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(C.hash_uniform(42, "c_custkey"), 9).alias("u"))


@query(f"""SELECT {D.picked(['online', 'mobile', 'branch', 'atm'], D.u(48, _KEY))} AS channel, count(*) AS n,
                  sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""")
def g2_pick(spark, d):
    """Equal-chance channel per order."""
    ch = C.pick(["online", "mobile", "branch", "atm"], C.hash_uniform(48, _KEY))
    return table(spark, d, "orders").groupBy(ch.alias("channel")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(f"""SELECT CASE WHEN {D.u(43, _KEY)} < 0.45::DOUBLE THEN 'deposit' WHEN {D.u(43, _KEY)} < 0.8::DOUBLE THEN 'withdrawal'
                  WHEN {D.u(43, _KEY)} < 0.9::DOUBLE THEN 'fee' ELSE 'interest' END AS txn_type, count(*) AS n,
                  sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""")
def g3_pick_weighted(spark, d):
    t = C.pick_weighted([("deposit", 45), ("withdrawal", 35), ("fee", 10), ("interest", 10)], C.hash_uniform(43, _KEY))
    return table(spark, d, "orders").groupBy(t.alias("txn_type")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(f"""SELECT o_orderstatus, count(*) AS n,
                  sum(round(100.0::DOUBLE + {D.u(44, _KEY)} * 5000.0::DOUBLE, 2)::DECIMAL(18,2))::DOUBLE AS paid_in,
                  sum(round(-50.0::DOUBLE + {D.u(45, _KEY)} * -2000.0::DOUBLE, 2)::DECIMAL(18,2))::DOUBLE AS paid_out
           FROM orders GROUP BY 1""")
def g4_uniform_amount(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"),
        A.money_sum(C.uniform_amount(100, 5000, C.hash_uniform(44, _KEY))).alias("paid_in"),
        A.money_sum(C.uniform_amount(-50, -2000, C.hash_uniform(45, _KEY))).alias("paid_out"))


@query(f"""SELECT c_custkey, (DATE '2001-08-01' - (floor({D.u(10, 'c_custkey')} * 200)::INT + 365))::DATE::VARCHAR AS joined,
                  (DATE '2001-08-01' + (floor({D.u(20, 'c_custkey')} * 38)::INT + 2))::DATE::VARCHAR AS matures FROM customer""")
def g5_date_draw(spark, d):
    ref = F.lit("2001-08-01").cast("date")
    return table(spark, d, "customer").select(
        "c_custkey", C.date_draw(ref, 200, C.hash_uniform(10, "c_custkey"), 365).cast("string").alias("joined"),
        C.date_draw(ref, 38, C.hash_uniform(20, "c_custkey"), 2, forward=True).cast("string").alias("matures"))


@query("""SELECT c_custkey, 'CUST-' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id,
                 'BR-' || lpad(c_nationkey::VARCHAR, 4, '0') AS branch_id FROM customer""")
def g6_make_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.make_key("CUST-", "c_custkey", 7).alias("customer_id"),
                                              C.make_key("BR-", "c_nationkey", 4).alias("branch_id"))


@query("""SELECT count(*) AS n, count(DISTINCT id)::BIGINT AS distinct_ids, min(id) AS first_id, max(id) AS last_id FROM (
          SELECT md5(l_orderkey || chr(1) || l_linenumber) AS id FROM lineitem)""")
def g7_surrogate_key(spark, d):
    """128-bit ids from the natural key. Line numbers repeat within an order here, so ids do too."""
    ids = table(spark, d, "lineitem").select(C.surrogate_key("l_orderkey", "l_linenumber").alias("id"))
    return ids.groupBy("id").agg(F.count("*").alias("m")).agg(
        F.sum("m").alias("n"), F.count("*").alias("distinct_ids"), F.min("id").alias("first_id"),
        F.max("id").alias("last_id"))


@query(f"SELECT o_orderkey, row_number() OVER (ORDER BY {D.u(7, _KEY)}, o_orderkey) AS id FROM orders")
def g7_surrogate_number(spark, d):
    """Consecutive ids without gaps or collisions."""
    return draw_rank(table(spark, d, "orders").select(_KEY), C.hash_uniform(7, _KEY), [_KEY], out="id")


@query("""SELECT c_custkey, c_mktsegment, c_custkey IN (SELECT user_id FROM events WHERE value >= 95) AS is_affected
          FROM customer""")
def g8_flag_members(spark, d):
    hot = table(spark, d, "events").filter("value >= 95").select(F.col("user_id").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return A.flag_members(c, "c_custkey", hot, "is_affected")


@query("""SELECT s_suppkey, o.day_offset, (DATE '2001-08-01' - o.day_offset)::DATE::VARCHAR AS day
          FROM supplier, (SELECT range::INT AS day_offset FROM range(14)) o""")
def g9_expand_days(spark, d):
    """Every supplier once for each of the last fourteen days."""
    s = table(spark, d, "supplier").select("s_suppkey")
    return A.expand_days(s, F.lit("2001-08-01").cast("date"), 14).withColumn("day", F.col("day").cast("string"))


@query(f"""WITH {D.FEATS} SELECT replace(customer_id, 'CUST-', 'CUST-D-') AS customer_id,
  total_outflow_60d_usd * 3.5::DOUBLE + -50000.0::DOUBLE AS total_outflow_60d_usd,
  total_balance_usd * 1.6::DOUBLE + 0.0::DOUBLE AS total_balance_usd, 1 AS has_maturing_cd,
  greatest(tier_rank, 1) + 1 AS tier_rank, withdrawal_count_60d + 8 AS withdrawal_count_60d,
  txn_count_60d + 5 AS txn_count_60d FROM feats""")
def g14_scenario_shift(spark, d):
    s = C.scenario_shift(D.features(spark, d))
    return s.select("customer_id", "total_outflow_60d_usd", "total_balance_usd", "has_maturing_cd", "tier_rank",
                    "withdrawal_count_60d", "txn_count_60d")


@query("""SELECT (ts - INTERVAL 3 DAYS)::DATE::VARCHAR AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def g15_shift_time(spark, d):
    ev = C.shift_time(table(spark, d, "events"), "ts", "3 DAYS")
    return ev.groupBy(F.to_date("ts").cast("string").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS quantity, l_extendedprice AS price
          FROM lineitem""")
def p1_project(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def p2_drop(spark, d):
    return table(spark, d, "part").drop("p_name", "p_type", "p_size")


@query(f"""WITH {D.C360} SELECT customer_id, tenure_years, total_balance_usd, num_products, num_deposit_products,
           has_maturing_cd, txn_count_60d, total_outflow_60d_usd, withdrawal_count_60d, tier_rank, churned FROM labelled""")
def p3_select_features(spark, d):
    return _feature_columns(D.labelled(spark, d))


def _feature_columns(df):
    return FT.select_features(df, ["customer_id"], FT.BASE_FEATURES, "churned", FT.LABEL_SOURCES)


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 1
          ELSE 0 END AS tier_rank FROM customer""")
def p4_ordinal(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.ordinal("c_mktsegment", D.TIERS).alias("tier_rank"))


_RISK_LEFT = f"WITH {D.RISK} SELECT c_custkey, {{}} FROM customer LEFT JOIN latest ON c_custkey = customer_id"


def _risk_left(spark, d):
    latest = A.latest_by(D.risk(spark, d), ["customer_id"], [F.desc("snapshot_date"), F.desc("event_id")])
    return table(spark, d, "customer").join(latest, F.col("c_custkey") == F.col("customer_id"), "left")


@query(_RISK_LEFT.format("""coalesce(attrition_risk_score, 0) AS attrition_risk_score,
                            coalesce(balance_outflow_30d_usd, 0) AS balance_outflow_30d_usd"""))
def p5_fill_defaults(spark, d):
    return (_risk_left(spark, d).select("c_custkey", "attrition_risk_score", "balance_outflow_30d_usd")
            .fillna({"attrition_risk_score": 0.0, "balance_outflow_30d_usd": 0.0}))


@query(f"WITH {D.HOLDINGS} SELECT status, maturity_date IS NULL AS open_ended, count(*) AS n FROM hold GROUP BY 1, 2")
def p6_maturity_status(spark, d):
    return D.holdings(spark, d).groupBy("status", F.col("maturity_date").isNull().alias("open_ended")).agg(
        F.count("*").alias("n"))


@query("""SELECT l_returnflag, count(*) AS n, sum(l_quantity)::BIGINT AS quantity FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag <> 'A'
            AND l_discount IS NOT NULL AND NOT (l_quantity > 40) GROUP BY 1""")
def p7_filters(spark, d):
    return (table(spark, d, "lineitem")
            .filter((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                    & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
            .filter((F.col("l_returnflag") != "A") & F.col("l_discount").isNotNull() & ~(F.col("l_quantity") > 40))
            .groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity")))


@query("""SELECT o_orderpriority, count(*) AS n, sum((substr(o_orderpriority, 1, 1) IN ('1', '2', '3'))::INT)::BIGINT AS deposits
          FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""")
def p8_string_predicates(spark, d):
    return (table(spark, d, "orders").filter(F.col("o_orderstatus").isin("F", "O")).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.count_if(C.starts_with_any("o_orderpriority", D.DEPOSITS)).alias("deposits")))


@query("""SELECT o_orderkey, o_custkey, o_orderdate::DATE::VARCHAR AS day FROM orders
          WHERE o_orderdate::DATE >= (SELECT max(o_orderdate)::DATE - 60 FROM orders)""")
def p9_within_days(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return A.within_days(o, "day", 60).withColumn("day", F.col("day").cast("string"))


@query(_RISK_LEFT.format("coalesce(attrition_risk_score, c_acctbal / 1e6, 0.5) AS risk"))
def p10_first_known(spark, d):
    return _risk_left(spark, d).select(
        "c_custkey", C.first_known("attrition_risk_score", F.col("c_acctbal") / 1e6, default=0.5).alias("risk"))


@query(f"WITH {D.C360} SELECT customer_id, churned FROM labelled")
def f1_churn_label(spark, d):
    return D.labelled(spark, d).select("customer_id", "churned")


@query("""SELECT c_custkey, CASE WHEN c_acctbal <= q1 THEN 0.0::DOUBLE WHEN c_acctbal < q3 THEN 1.0::DOUBLE
                 ELSE 2.0::DOUBLE END AS band
          FROM customer, (SELECT quantile_disc(c_acctbal, 0.25) AS q1, quantile_disc(c_acctbal, 0.75) AS q3 FROM customer)""")
def f2_quartile_band(spark, d):
    return FT.quartile_band(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "band").drop(
        "c_acctbal")


def _draw_sql(key: str) -> str:
    return D.u("42|split", key)


@query(f"""SELECT o_orderkey, o_orderstatus, {_draw_sql('o_orderkey')} < 0.2::DOUBLE AS is_test FROM orders""")
def f4_stratified_split(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return FT.stratified_split(o, ["o_orderkey"], "o_orderstatus")


@query(f"""SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_draw_sql('o_orderkey')}, o_orderkey)
    <= round(count(*) OVER (PARTITION BY o_orderstatus) * 0.2::DOUBLE) AS is_test FROM orders""")
def f4_stratified_split_exact(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return FT.stratified_split(o, ["o_orderkey"], "o_orderstatus", exact=True)


@query("""SELECT toxic, n, round(t / (k * n), 6) AS balanced_weight, round(neg / greatest(pos, 1), 3) AS neg_pos_ratio FROM (
  SELECT toxic, count(*) AS n FROM labels GROUP BY 1), (SELECT count(*)::DOUBLE AS t, count(DISTINCT toxic) AS k,
  count(*) FILTER (toxic = 0)::DOUBLE AS neg, count(*) FILTER (toxic = 1) AS pos FROM labels)""")
def f5_class_weights(spark, d):
    w = FT.class_weights(table(spark, d, "labels"), "toxic")
    return w.withColumn("balanced_weight", F.round("balanced_weight", 6))
