"""Assembly, joins, set operations, windows and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import assemble as A
from churnkit.operators import features as FT
from churnkit.operators.order import running_counts
from churnkit.operators.payload import batch_rows
from churnkit.plans import data as D
from churnkit.plans.registry import query, table
from churnkit.session import scratch_path

_C360_COLS = ("customer_id, tier, tier_rank, tenure_years, home_metro, state, annual_income_band, num_products, "
              "total_balance_usd, num_deposit_products, has_maturing_cd, txn_count_60d, total_outflow_60d_usd, "
              "withdrawal_count_60d, attrition_risk_score, balance_outflow_30d_usd")


@query(f"WITH {D.C360} SELECT {_C360_COLS}, churned FROM labelled")
def customer_360(spark, d):
    """One labelled row per customer: the flagship query."""
    return D.labelled(spark, d).select(*_C360_COLS.split(", "), "churned")


@query(f"WITH {D.C360} SELECT {_C360_COLS} FROM c360")
def j1_customer_360(spark, d):
    return D.c360(spark, d).select(*_C360_COLS.split(", "))


@query("SELECT doc_id, quality, toxic, lang, n_chars FROM labels JOIN documents USING (doc_id)")
def j2_inner_join(spark, d):
    return (table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
            .select("doc_id", "quality", "toxic", "lang", "n_chars"))


@query(f"""WITH {D.FEATS} SELECT tenure_years, total_balance_usd, txn_count_60d, tier_rank, "balanceCategory", churned
           FROM feats""")
def j3_training_set(spark, d):
    """Labels keyed by customer, features looked up by key in the published table, key dropped."""
    feats = FT.publish_features(D.features(spark, d), ["customer_id"], scratch_path(spark, "features"))
    labels = feats.select("customer_id", "churned")
    names = ["tenure_years", "total_balance_usd", "txn_count_60d", "tier_rank", "balanceCategory"]
    return FT.training_set(labels, feats.drop("churned"), names, "customer_id", "churned").select(*names, "churned")


@query("""SELECT u.user_id AS c_custkey, c_acctbal, c_mktsegment, c_custkey IS NOT NULL AS is_matched
          FROM (SELECT DISTINCT user_id * 13 AS user_id FROM events) u LEFT JOIN customer ON u.user_id = c_custkey""")
def j4_lookup(spark, d):
    """Features by key, unmatched keys reported."""
    keys = table(spark, d, "events").select((F.col("user_id") * 13).alias("c_custkey")).distinct()
    return FT.lookup(keys, table(spark, d, "customer"), ["c_acctbal", "c_mktsegment"], "c_custkey")


@query("""SELECT n_name, tier FROM nation, (SELECT unnest(['entry', 'middle', 'upper']) AS tier)""")
def j5_pair_with(spark, d):
    """Every nation with every tier, by exploding a literal list."""
    return A.pair_with(table(spark, d, "nation").select("n_name"), ["entry", "middle", "upper"], "tier")


@query("""SELECT l_returnflag, count(*) AS n, count(p_partkey) AS matched,
                 sum(coalesce(p_retailprice, 0)::DECIMAL(18,2))::DOUBLE AS retail
          FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def j6_dim_lookup(spark, d):
    """Retail price of each line's part, 0 for parts the dimension does not list."""
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_partkey")
    priced = A.dim_lookup(lines, table(spark, d, "part"), "l_partkey", "p_retailprice", 0.0, dim_key="p_partkey")
    return priced.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_if(F.col("p_retailprice") > 0).alias("matched"),
        A.money_sum(F.col("p_retailprice")).alias("retail"))


@query("""SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def j7_keep_members(spark, d):
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return A.keep_members(table(spark, d, "customer"), urgent, "c_custkey")


@query("""SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE value >= 42)""")
def j8_drop_members(spark, d):
    at_risk = table(spark, d, "events").filter("value >= 42").select(F.col("user_id").alias("c_custkey"))
    return A.drop_members(table(spark, d, "customer"), at_risk, "c_custkey")


@query(f"WITH {D.HOLDINGS} SELECT * FROM hold_agg")
def a1_holdings_agg(spark, d):
    return A.holdings_agg(D.holdings(spark, d), D.DEPOSITS)


@query(f"WITH {D.TRANSACTIONS} SELECT * FROM txn_agg")
def a2_txn_agg(spark, d):
    return A.txn_agg(D.transactions(spark, d), 60, D.last_order_day(table(spark, d, "orders")))


@query("SELECT max(ts)::DATE::VARCHAR AS last_day, max(event_id) AS last_event FROM events")
def a3_global_max(spark, d):
    return table(spark, d, "events").agg(F.max(F.to_date("ts")).cast("string").alias("last_day"),
                                         F.max("event_id").alias("last_event"))


@query("""SELECT user_id, event_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def w1_latest_by(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return A.latest_by(ev, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query(f"""SELECT c_custkey, row_number() OVER w AS row_number, ((row_number() OVER w - 1) // 25)::BIGINT AS batch
           FROM customer WINDOW w AS (ORDER BY c_acctbal, {D.u(42, 'c_custkey')}, c_custkey)""")
def w2_batch_rows(spark, d):
    """Batches of 25 in balance order."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return batch_rows(c, 25, ["c_custkey"], order="c_acctbal").drop("c_acctbal")


@query(f"""SELECT o_orderstatus, o_orderkey, row_number() OVER w AS row_number,
                  ((row_number() OVER w - 1) // 50)::BIGINT AS batch
           FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY {D.u(42, 'o_orderkey')}, o_orderkey)""")
def w2_batch_rows_shuffled(spark, d):
    """Batches of 50 per status in keyed random order."""
    o = table(spark, d, "orders").select("o_orderstatus", "o_orderkey")
    return batch_rows(o, 50, ["o_orderkey"], by=["o_orderstatus"])


@query(f"""WITH {D.SCORED}, g AS (SELECT score, sum(y)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY score)
           SELECT score, pos, n, (sum(pos) OVER w)::BIGINT AS pos_upto, (sum(n) OVER w)::BIGINT AS n_upto
           FROM g WINDOW w AS (ORDER BY score DESC)""")
def w3_running_counts(spark, d):
    """Positives and rows at and above each distinct score."""
    s = D.scored_orders(spark, d)
    return running_counts(s, "score", {"pos": F.count_if(F.col("y") == 1), "n": F.count("*")})


@query("""SELECT r_name, c_mktsegment, count(*) AS n, round(avg((c_acctbal < 0)::INT), 4) AS rate,
                 round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*), 2) AS avg_acctbal
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          GROUP BY 1, 2 ORDER BY rate DESC""")
def t1_sorted_rates(spark, d):
    """Rate and mean per group, highest rate first."""
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .groupBy("r_name", "c_mktsegment")
            .agg(F.count("*").alias("n"), F.round(F.avg((F.col("c_acctbal") < 0).cast("int")), 4).alias("rate"),
                 F.round(A.money_sum(F.col("c_acctbal")) / F.count("*"), 2).alias("avg_acctbal"))
            .orderBy(F.desc("rate"), "r_name", "c_mktsegment"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t2_take_rows(spark, d):
    return (table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20))


@query("""SELECT event_type, event_id, user_id, value FROM events WHERE event_type IN ('refund', 'purchase', 'click')
          ORDER BY CASE event_type WHEN 'refund' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END, ts DESC, event_id DESC LIMIT 1""")
def t3_latest_preferred(spark, d):
    """Newest event of the first kind that occurs; the first choice has no rows."""
    ev = table(spark, d, "events").select("event_type", "event_id", "user_id", "value", "ts")
    return A.latest_preferred(ev, "event_type", ["refund", "purchase", "click"],
                              [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""SELECT c_mktsegment, round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(*), 4) AS metric FROM customer
          GROUP BY 1 ORDER BY metric DESC, c_mktsegment LIMIT 1""")
def t4_best_by(spark, d):
    per = table(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.round(A.money_sum(F.col("c_acctbal")) / F.count("*"), 4).alias("metric"))
    return A.best_by(per, "metric", ["c_mktsegment"])


def _at_risk(spark, d):
    return D.labelled(spark, d).select("customer_id", "tier", "total_balance_usd", F.col("churned").alias("prediction"))


@query(f"""WITH {D.C360} SELECT customer_id, tier, total_balance_usd, churned AS prediction FROM labelled WHERE churned = 1
           ORDER BY total_balance_usd DESC, customer_id LIMIT 20""")
def t5_top_at_risk(spark, d):
    return A.top_at_risk(_at_risk(spark, d), "total_balance_usd", 20)


@query(f"""WITH {D.C360} SELECT customer_id, tier, total_balance_usd, churned AS prediction,
           (row_number() OVER (PARTITION BY tier ORDER BY total_balance_usd DESC, customer_id))::INT AS rank
           FROM labelled WHERE churned = 1 QUALIFY rank <= 5""")
def t5_top_at_risk_per_tier(spark, d):
    return A.top_at_risk(_at_risk(spark, d), "total_balance_usd", 5, within="tier")


@query("""SELECT s_suppkey AS key, s_acctbal AS balance, 'supplier' AS kind FROM supplier
          UNION ALL SELECT c_custkey, c_acctbal, 'customer' FROM customer""")
def u1_union_by_name(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"),
                                           F.lit("supplier").alias("kind"))
    c = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"),
                                           F.col("c_custkey").alias("key"))
    return s.unionByName(c)


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def u2_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity").distinct()
