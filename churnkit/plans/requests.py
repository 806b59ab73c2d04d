"""Request logs: packing, parsing, unpacking."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions import columns as C
from churnkit.operators import payload as P
from churnkit.operators.features import FEATURES
from churnkit.plans import data as D
from churnkit.plans.registry import query, table

SIZE = 25


def retried_log(spark, d):
    """The request log with about a third of the requests delivered again a second later, some of them twice."""
    log = request_log(spark, d)
    again = F.when(C.hash_uniform(11, "request_id") < 0.1, 3).when(C.hash_uniform(11, "request_id") < 0.33, 2).otherwise(1)
    times = log.withColumn("_try", F.explode(F.sequence(F.lit(0), again - 1)))
    return times.withColumn("timestamp_ms", F.col("timestamp_ms") + 1000 * F.col("_try")).drop("_try")


def request_log(spark, d):
    """Requests of 25 customers each, with answers; about a tenth of them failed."""
    feats = D.features(spark, d)
    order = table(spark, d, "customer").select("c_custkey", C.make_key("CUST-", "c_custkey", 7).alias("customer_id"))
    numbered = P.batch_rows(order, SIZE, ["c_custkey"]).drop("c_custkey")
    rows = feats.join(numbered, "customer_id")
    # one aggregation makes both documents of a batch
    member = F.struct("row_number", F.struct(*[F.col(f).cast("double").alias(f) for f in FEATURES], "customer_id").alias("r"),
                      F.col("churned").cast("double").alias("p"))
    packed = rows.groupBy("batch").agg(F.array_sort(F.collect_list(member)).alias("m"))
    return packed.select(
        C.make_key("req-", "batch", 8).alias("request_id"),
        F.to_json(F.struct(F.col("m.r").alias(P.RECORDS)), {"ignoreNullFields": "false"}).alias("request"),
        F.to_json(F.struct(F.col("m.p").alias(P.PREDICTIONS)), {"ignoreNullFields": "false"}).alias("response"),
        F.when(C.hash_uniform(9, "batch") < 0.1, 500).otherwise(200).alias("status_code"),
        (F.lit(1704067200000) + F.col("batch") * 60000).alias("timestamp_ms"))


_BATCHES = f"""numbered AS (SELECT 'CUST-' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id, row_number() OVER (
    ORDER BY {D.u(42, 'c_custkey')}, c_custkey) AS row_number FROM customer),
batches AS (SELECT *, (row_number - 1) // {SIZE} AS batch FROM numbered)"""

_VALUES = ", ".join(f'"{f}"::DOUBLE AS "{f}"' for f in FEATURES)
_UNPACKED = f"""SELECT 'req-' || lpad(batch::VARCHAR, 8, '0') AS request_id, ((row_number - 1) % {SIZE})::INT AS position,
  (TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * batch)::VARCHAR AS inference_time, 'served' AS model_version, customer_id,
  {_VALUES}, churned::DOUBLE AS prediction
  FROM feats JOIN batches USING (customer_id) WHERE {D.u(9, 'batch')} >= 0.1::DOUBLE"""


@query("""SELECT event_id, regexp_extract(props, '-?[0-9]+')::BIGINT AS k FROM events""")
def x1_parse_json(spark, d):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return table(spark, d, "events").select("event_id", P.parse_json("props", schema)["k"].alias("k"))


@query("""SELECT o_orderkey, i.i - 1 AS position, p[i.i] AS part, q[i.i] AS quantity FROM (
  SELECT l_orderkey AS o_orderkey, list(l_partkey ORDER BY l_partkey, l_quantity) AS p,
         list(l_quantity ORDER BY l_partkey, l_quantity)[1:3] AS q FROM lineitem GROUP BY 1), range(1, 64) i(i)
  WHERE i.i <= len(p)""")
def x2_zip_explode(spark, d):
    """Part list of each order against a shorter quantity list: missing places are null."""
    members = F.array_sort(F.collect_list(F.struct("l_partkey", "l_quantity")))
    lists = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(members.alias("m")).select(
        "o_orderkey", F.col("m.l_partkey").alias("p"), F.slice("m.l_quantity", 1, 3).alias("q"))
    return lists.select("o_orderkey", F.posexplode(F.arrays_zip("p", "q")).alias("position", "z")).select(
        "o_orderkey", F.col("position").cast("long").alias("position"), F.col("z.p").alias("part"),
        F.col("z.q").alias("quantity"))


@query(f"WITH {D.FEATS}, {_BATCHES} {_UNPACKED}")
def x3_unpack_payload(spark, d):
    """Feature rows packed into requests, logged, and unpacked again."""
    out = P.unpack_payload(request_log(spark, d), FEATURES)
    return out.withColumn("inference_time", F.col("inference_timestamp").cast("string")).drop("inference_timestamp")


@query(f"WITH {D.FEATS}, {_BATCHES} {_UNPACKED}")
def x3_first_deliveries(spark, d):
    """The same from a log in which requests were retried: each counts once, as first delivered."""
    out = P.unpack_payload(P.first_deliveries(retried_log(spark, d)), FEATURES)
    return out.withColumn("inference_time", F.col("inference_timestamp").cast("string")).drop("inference_timestamp")


@query("""SELECT ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1""")
def x4_event_time(spark, d):
    """Event time from an epoch column, found by the schema."""
    ev = table(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"))
    return ev.groupBy(F.to_date(P.event_time(ev)).cast("string").alias("day")).agg(F.count("*").alias("n"))


@query(f"""WITH {_BATCHES} SELECT batch::BIGINT AS batch, count(*) AS n_records, min(customer_id) AS first_id, max(customer_id) AS last_id
  FROM batches GROUP BY 1""")
def x5_pack_payload(spark, d):
    """Requests of 25 records; what they hold is read back from the JSON."""
    c = table(spark, d, "customer").select("c_custkey", C.make_key("CUST-", "c_custkey", 7).alias("customer_id"), "c_acctbal")
    packed = P.pack_payload(P.batch_rows(c, SIZE, ["c_custkey"]), ["c_acctbal"])
    ids = P.parse_json("request", P.request_schema(["c_acctbal"]))[P.RECORDS]["customer_id"]
    return packed.select("batch", F.size(ids).cast("long").alias("n_records"), F.array_min(ids).alias("first_id"),
                         F.array_max(ids).alias("last_id"))
