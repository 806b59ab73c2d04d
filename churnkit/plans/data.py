"""The bank's datasets, expressed over the tables at hand, in DataFrame and in SQL form.

customers <- customer, nation, region    holdings     <- orders
risk      <- events                      transactions <- orders, lineitem
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.columns import hash_uniform, make_key, maturity_status
from churnkit.operators.assemble import customer_360, global_max
from churnkit.operators.features import BASE_FEATURES, FEATURES, LABEL_SOURCES, churn_label, quartile_band, select_features
from churnkit.plans.registry import table

TIERS = {"AUTOMOBILE": 3, "BUILDING": 2, "FURNITURE": 1}
DEPOSITS = ("1", "2", "3")
TERM_PRODUCTS = ("1-URGENT", "2-HIGH")
KEY = "customer_id"


def customers(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias(KEY), F.col("c_mktsegment").alias("tier"),
                    (F.col("c_custkey") % 23).cast("int").alias("tenure_years"),
                    F.col("n_name").alias("home_metro"), F.col("r_name").alias("state"),
                    F.concat(F.lit("band "), F.floor(F.col("c_acctbal") / 2500).cast("string")).alias("annual_income_band")))


def last_order_day(orders: DataFrame) -> Column:
    return global_max(orders.select(F.to_date("o_orderdate").alias("day")), "day")


def holdings(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    maturity = F.when(F.col("o_orderpriority").isin(*TERM_PRODUCTS), day)
    return o.select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias(KEY),
                    F.col("o_orderpriority").alias("product_id"), F.col("o_totalprice").alias("balance_usd"),
                    day.alias("open_date"), maturity.alias("maturity_date"),
                    maturity_status(maturity, F.date_sub(last_order_day(o), 30)).alias("status"))


def transactions(spark: SparkSession, d: str) -> DataFrame:
    # the day stays as stored, so that the recency filter can reach the scan
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("txn_date"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    out = F.col("l_returnflag") == "R"
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias(KEY), "txn_date",
        F.when(out, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount_usd"),
        F.when(out & (F.col("l_linenumber") % 2 == 0), "transfer_out").when(out, "withdrawal")
        .when(F.col("l_returnflag") == "A", "fee").otherwise("deposit").alias("txn_type"))


def risk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias(KEY), F.col("ts").alias("snapshot_date"), "event_id",
        F.least(F.lit(0.95), F.col("value") / 100).alias("attrition_risk_score"),
        F.round(F.col("value") * 10, 2).alias("balance_outflow_30d_usd"))


def c360(spark: SparkSession, d: str) -> DataFrame:
    return customer_360(
        customers(spark, d), holdings(spark, d), transactions(spark, d), risk(spark, d), TIERS, DEPOSITS,
        ref=last_order_day(table(spark, d, "orders")), risk_order=[F.desc("snapshot_date"), F.desc("event_id")])


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return churn_label(c360(spark, d))


def features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table with its label and string keys."""
    base = select_features(labelled(spark, d), [KEY], BASE_FEATURES, "churned", LABEL_SOURCES)
    # the quartiles need balances only: one pass over orders, not the whole assembly
    banded = quartile_band(base, cuts=balance_quartiles(spark, d))
    return banded.withColumn(KEY, make_key("CUST-", KEY, 7)).select(KEY, *FEATURES, "churned")


def balance_quartiles(spark: SparkSession, d: str) -> list[float]:
    from churnkit.operators.assemble import money_sum
    from churnkit.operators.order import quantiles
    per = table(spark, d, "orders").groupBy("o_custkey").agg(money_sum(F.col("o_totalprice")).alias("b"))
    every = (table(spark, d, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
             .select(F.coalesce("b", F.lit(0.0)).alias("b")))
    return quantiles(every, "b", [0.25, 0.75])


def scored_orders(spark: SparkSession, d: str, seed: int = 7) -> DataFrame:
    """A labelled, scored set: y from the priority, a noisy score, class at 0.5."""
    y = F.col("o_orderpriority").isin(*TERM_PRODUCTS).cast("int")
    score = F.lit(0.7) * hash_uniform(seed, "o_orderkey") + F.lit(0.3) * y
    return (table(spark, d, "orders").select("o_orderkey", "o_orderstatus", y.alias("y"), score.alias("score"))
            .withColumn("yhat", (F.col("score") >= 0.5).cast("int")))


def inference_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as scored rows: prediction is value over 40, version by user, event type as slice."""
    return table(spark, d, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", (F.col("value") > 40).cast("int").alias("prediction"),
        (F.col("user_id") % 2).cast("string").alias("model_version"))


# --- SQL forms ---------------------------------------------------------------------

def u(seed, key: str) -> str:
    """SQL of the keyed draw."""
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def picked(values, draw: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[floor({draw} * {len(values)})::INT + 1]"


CUSTOMERS = f"""
cust AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS tier, (c_custkey % 23)::INT AS tenure_years,
         n_name AS home_metro, r_name AS state, 'band ' || floor(c_acctbal / 2500)::BIGINT::VARCHAR AS annual_income_band
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

HOLDINGS = """
lastday AS (SELECT max(o_orderdate)::DATE AS day FROM orders),
hold AS (
  SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderpriority AS product_id,
         o_totalprice AS balance_usd, o_orderdate::DATE AS open_date,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate::DATE END AS maturity_date,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate::DATE < (SELECT day FROM lastday) - 30
              THEN 'matured' ELSE 'active' END AS status
  FROM orders),
hold_agg AS (
  SELECT customer_id, count(*) AS num_products, sum(balance_usd::DECIMAL(18,2))::DOUBLE AS total_balance_usd,
         count(*) FILTER (substr(product_id, 1, 1) IN ('1', '2', '3')) AS num_deposit_products,
         max(CASE WHEN maturity_date IS NOT NULL AND status = 'active' THEN 1 ELSE 0 END) AS has_maturing_cd
  FROM hold GROUP BY customer_id)"""

TRANSACTIONS = """
txn AS (
  SELECT o_custkey AS customer_id, o_orderdate::DATE AS txn_date,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount_usd,
         CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'transfer_out' WHEN l_returnflag = 'R'
              THEN 'withdrawal' WHEN l_returnflag = 'A' THEN 'fee' ELSE 'deposit' END AS txn_type
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
txn_agg AS (
  SELECT customer_id, count(*) AS txn_count_60d,
         sum(CASE WHEN amount_usd < 0 THEN amount_usd ELSE 0 END::DECIMAL(18,2))::DOUBLE AS total_outflow_60d_usd,
         count(*) FILTER (txn_type IN ('withdrawal', 'transfer_out')) AS withdrawal_count_60d
  FROM txn WHERE txn_date >= (SELECT max(o_orderdate)::DATE - 60 FROM orders) GROUP BY customer_id)"""

RISK = """
risk AS (
  SELECT user_id AS customer_id, ts AS snapshot_date, event_id, least(0.95::DOUBLE, value / 100) AS attrition_risk_score,
         round(value * 10, 2) AS balance_outflow_30d_usd FROM events),
latest AS (
  SELECT customer_id, attrition_risk_score, balance_outflow_30d_usd FROM risk
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC, event_id DESC) = 1)"""

TIER_RANK = ("CASE tier WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 1 ELSE 0 END")

C360 = f"{CUSTOMERS}, {HOLDINGS}, {TRANSACTIONS}, {RISK}, " + f"""
c360 AS (
  SELECT customer_id, tier, tenure_years, home_metro, state, annual_income_band,
         coalesce(attrition_risk_score, 0) AS attrition_risk_score,
         coalesce(balance_outflow_30d_usd, 0) AS balance_outflow_30d_usd,
         coalesce(txn_count_60d, 0) AS txn_count_60d, coalesce(total_outflow_60d_usd, 0) AS total_outflow_60d_usd,
         coalesce(withdrawal_count_60d, 0) AS withdrawal_count_60d, coalesce(num_products, 0) AS num_products,
         coalesce(total_balance_usd, 0) AS total_balance_usd, coalesce(num_deposit_products, 0) AS num_deposit_products,
         coalesce(has_maturing_cd, 0) AS has_maturing_cd, {TIER_RANK} AS tier_rank
  FROM cust LEFT JOIN latest USING (customer_id) LEFT JOIN txn_agg USING (customer_id)
            LEFT JOIN hold_agg USING (customer_id)),
labelled AS (
  SELECT *, ({u(42, 'customer_id')} < CASE WHEN attrition_risk_score >= 0.42::DOUBLE THEN 0.85::DOUBLE ELSE
      0.06::DOUBLE + CASE WHEN total_outflow_60d_usd < 0 THEN 0.06::DOUBLE ELSE 0 END
      + CASE WHEN tier_rank >= 2 THEN 0.03::DOUBLE ELSE 0 END
      + CASE WHEN has_maturing_cd = 1 THEN 0.03::DOUBLE ELSE 0 END END)::INT AS churned FROM c360)"""

FEATS = C360 + """,
cuts AS (SELECT quantile_disc(total_balance_usd, 0.25) AS q1, quantile_disc(total_balance_usd, 0.75) AS q3 FROM labelled),
feats AS (
  SELECT 'CUST-' || lpad(customer_id::VARCHAR, 7, '0') AS customer_id, tenure_years, total_balance_usd, num_products,
         num_deposit_products, has_maturing_cd, txn_count_60d, total_outflow_60d_usd, withdrawal_count_60d, tier_rank,
         CASE WHEN total_balance_usd <= q1 THEN 0.0::DOUBLE WHEN total_balance_usd < q3 THEN 1.0::DOUBLE
              ELSE 2.0::DOUBLE END AS "balanceCategory", churned
  FROM labelled, cuts)"""

SCORED = f"""
scored AS (
  SELECT *, (score >= 0.5::DOUBLE)::INT AS yhat FROM (
    SELECT o_orderkey, o_orderstatus, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS y,
           0.7::DOUBLE * {u(7, 'o_orderkey')} + 0.3::DOUBLE * (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS score
    FROM orders))"""

LOG = """
ilog AS (
  SELECT event_id, ts, user_id, event_type, value, (value > 40)::INT AS prediction, (user_id % 2)::VARCHAR AS model_version
  FROM events)"""
