"""Sources, sinks and keyed change feeds, each as a round trip over a given table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions import columns as C
from churnkit.plans import data as D
from churnkit.plans.registry import SQL, query, table
from churnkit.session import scratch_path
from churnkit.sources import sync, tables, versions


@query("SELECT * FROM orders")
def s1_read_parquet(spark, d):
    return tables.read(spark, d, "orders.parquet")


@query("SELECT * FROM customer")
def s2_save_parquet(spark, d):
    return tables.save(table(spark, d, "customer"), scratch_path(spark, "customer"))


@query("SELECT * FROM part")
def s3_save_table(spark, d):
    """Catalog table bucketed by key, stored in the shared folder."""
    name = f"part_{uuid.uuid4().hex}"
    return tables.save_table(table(spark, d, "part"), name, scratch_path(spark, name), ["p_partkey"], 8)


@query("""SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice FROM part""")
def s4_append_log(spark, d):
    """Two appends, the second with a new column; earlier rows read as null there."""
    p, path = table(spark, d, "part"), scratch_path(spark, "log")
    tables.append_log(p.filter("p_size <= 25").select("p_partkey", "p_brand"), path)
    tables.append_log(p.filter("p_size > 25").select("p_partkey", "p_brand", "p_retailprice"), path)
    return tables.read_log(spark, path).select("p_partkey", "p_brand", "p_retailprice")


@query("""SELECT s_name, s_suppkey::VARCHAR AS s_suppkey, s_nationkey::BIGINT AS s_nationkey, NULL::DOUBLE AS s_rating
          FROM supplier""")
def s5_align_to(spark, d):
    target = T.StructType([T.StructField("s_name", T.StringType()), T.StructField("s_suppkey", T.StringType()),
                           T.StructField("s_nationkey", T.LongType()), T.StructField("s_rating", T.DoubleType())])
    return tables.align_to(table(spark, d, "supplier"), target)


@query("""SELECT c_custkey, tier_rank, tier_name FROM customer JOIN (VALUES ('AUTOMOBILE', 3, 'private'),
          ('BUILDING', 2, 'affluent'), ('FURNITURE', 1, 'mass_affluent')) v(seg, tier_rank, tier_name) ON c_mktsegment = seg""")
def s6_declared_rows(spark, d):
    """A literal table with a declared schema, joined to the customers."""
    tiers = tables.rows(spark, [("AUTOMOBILE", 3, "private"), ("BUILDING", 2, "affluent"), ("FURNITURE", 1, "mass_affluent")],
                        "c_mktsegment string, tier_rank int, tier_name string")
    return table(spark, d, "customer").join(tiers, "c_mktsegment").select("c_custkey", "tier_rank", "tier_name")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def s7_ensure(spark, d):
    """Built by the first call, reused by the second."""
    path = scratch_path(spark, "geo")

    def build():
        n, r = table(spark, d, "nation"), table(spark, d, "region")
        return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")

    tables.ensure(spark, path, build)
    return tables.ensure(spark, path, lambda: build().limit(0))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s8_read_csv(spark, d):
    """CSV with header; types found by inference."""
    path = scratch_path(spark, "supplier")
    table(spark, d, "supplier").write.option("header", "true").csv(path)
    got = tables.read_csv(spark, path)
    return got.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", "s_nationkey", "s_acctbal")


@query(f"""WITH {D.SCORED} SELECT o_orderkey, y, score, yhat FROM scored ORDER BY o_orderkey LIMIT 200""")
def s9_write_sample(spark, d):
    """A bounded sample of predictions as CSV: the row limit is the feature."""
    path = scratch_path(spark, "sample")
    scored = D.scored_orders(spark, d).select("o_orderkey", "y", "score", "yhat")
    tables.write_sample(scored, 200, path, ["o_orderkey"])
    return tables.read_csv(spark, path, scored.schema)


_OLD = f"""old AS (SELECT c_custkey, c_mktsegment, CASE WHEN {D.u(3, 'c_custkey')} < 0.2::DOUBLE THEN NULL ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE {D.u(1, 'c_custkey')} >= 0.1::DOUBLE), new AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
  WHERE {D.u(2, 'c_custkey')} >= 0.1::DOUBLE)"""


def _versions(spark, d):
    """An older and a newer version of the customers: rows added, removed and changed from null."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    old = c.filter(C.hash_uniform(1, "c_custkey") >= 0.1).withColumn(
        "c_acctbal", F.when(C.hash_uniform(3, "c_custkey") >= 0.2, F.col("c_acctbal")))
    return old, c.filter(C.hash_uniform(2, "c_custkey") >= 0.1)


@query(f"""WITH {_OLD} SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
  CASE WHEN n.c_custkey IS NULL THEN o.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment,
  CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
  CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS _change_type
  FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey
  WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal IS DISTINCT FROM n.c_acctbal
     OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment""")
def s10_change_feed(spark, d):
    old, new = _versions(spark, d)
    return sync.change_feed(old, new, ["c_custkey"])


@query(f"WITH {_OLD} SELECT * FROM new")
def s11_upsert(spark, d):
    """The older version plus its change feed is the newer version."""
    old, new = _versions(spark, d)
    return sync.upsert(old, sync.change_feed(old, new, ["c_custkey"]), ["c_custkey"])


@query(SQL["s10_change_feed"])
def s10_version_feed(spark, d):
    """The same feed between two saved versions, from the buckets whose digests differ."""
    old, new = _versions(spark, d)
    paths = [scratch_path(spark, n) for n in ("older", "newer")]
    for df, path in zip((old, new), paths, strict=True):
        versions.save_version(df, ["c_custkey"], path, 64)
    return versions.version_feed(spark, *paths, old.schema, ["c_custkey"])


@query(SQL["s11_upsert"])
def s11_bucketed_replica(spark, d):
    """The older version brought up to date by two batches of changes, which are merged when it is read."""
    old, new = _versions(spark, d)
    replica = versions.Replica(spark, scratch_path(spark, "replica"), old.schema, ["c_custkey"], 16, 2)
    replica.create(old)
    feed = sync.change_feed(old, new, ["c_custkey"])
    for number in (1, 2):
        replica.apply(feed.filter(F.col("c_custkey") % 2 == number - 1), number)
    return replica.read()


@query("""SELECT c_custkey AS id, 'CUST-' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id, (c_custkey % 12)::BIGINT AS metro,
  coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def s12_int_range(spark, d):
    """The range up to the largest key, met with the keys there are and with their orders; gaps in the keys fall out."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    top = c.agg(F.max("id")).first()[0] or 0
    ids = tables.int_range(spark, top + 1, customer_id=C.make_key("CUST-", "id", 7), metro=F.col("id") % 12)
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return (ids.join(c, "id", "left_semi").join(orders, "id", "left")
            .select("id", "customer_id", "metro", F.coalesce("n", F.lit(0)).alias("n_orders")))


@query(f"""WITH {D.FEATS} SELECT * FROM feats""")
def f3_publish_features(spark, d):
    """Feature table written after its key was checked."""
    from churnkit.operators.features import publish_features
    return publish_features(D.features(spark, d), ["customer_id"], scratch_path(spark, "features"))
