import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit import session as S
from churnkit.sources import sync, tables

OLD = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0)]
NEW = [(1, "a", 1.0), (2, "b", 2.0), (4, None, 4.0), (5, "e", None)]
DDL = "k int, name string, v double"


def _rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_change_feed(spark):
    feed = sync.change_feed(spark.createDataFrame(OLD, DDL), spark.createDataFrame(NEW, DDL), ["k"])
    assert {(r.k, r._change_type, r.name, r.v) for r in feed.collect()} == {
        (2, "update", "b", 2.0), (3, "delete", "c", 3.0), (4, "update", None, 4.0), (5, "insert", "e", None)}


def test_change_feed_preimages(spark):
    feed = sync.change_feed(spark.createDataFrame(OLD, DDL), spark.createDataFrame(NEW, DDL), ["k"], preimages=True)
    pre = {(r.k, r.name, r.v) for r in feed.filter("_change_type = 'update_preimage'").collect()}
    assert pre == {(2, "b", None), (4, "d", 4.0)}


def test_upsert_applies_the_feed(spark):
    old, new = spark.createDataFrame(OLD, DDL), spark.createDataFrame(NEW, DDL)
    for pre in (False, True):
        got = sync.upsert(old, sync.change_feed(old, new, ["k"], preimages=pre), ["k"])
        assert _rows(got, "k", "name", "v") == _rows(new, "k", "name", "v")


def test_upsert_without_change_type(spark):
    got = sync.upsert(spark.createDataFrame(OLD, DDL), spark.createDataFrame([(3, "z", 9.0), (9, "n", 0.0)], DDL), ["k"])
    assert {(r.k, r.name) for r in got.collect()} == {(1, "a"), (2, "b"), (3, "z"), (4, "d"), (9, "n")}


def test_align_to(spark):
    target = T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.LongType()),
                           T.StructField("x", T.DateType())])
    got = tables.align_to(spark.createDataFrame(OLD, DDL), target)
    assert got.dtypes == [("v", "string"), ("k", "bigint"), ("x", "date")]
    assert got.filter("x IS NOT NULL").count() == 0 and got.count() == 4


def test_log_with_new_columns(spark):
    path = S.scratch_path(spark, "t-log")
    tables.append_log(spark.createDataFrame([(1,)], "a int"), path)
    tables.append_log(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted(map(tuple, tables.read_log(spark, path).select("a", "b").collect())) == [(1, None), (2, "x")]


def test_ensure_builds_once(spark):
    path, calls = S.scratch_path(spark, "t-ensure"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.ensure(spark, path, build).count() == 3
    assert tables.ensure(spark, path, build).count() == 3
    assert len(calls) == 1


def test_ensure_table_and_csv_sample(spark):
    name = "t_ensure_table"
    for _ in range(2):
        assert tables.ensure_table(spark, name, lambda: spark.range(4), S.scratch_path(spark, "t")).count() == 4
    path = S.scratch_path(spark, "t-csv")
    tables.write_sample(spark.range(50).withColumn("p", F.col("id") * 0.5), 7, path, ["id"])
    got = tables.read_csv(spark, path)
    assert [r.id for r in got.orderBy("id").collect()] == list(range(7)) and dict(got.dtypes)["p"] == "double"


def test_shared_dir_is_the_named_one(spark):
    assert S.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_null_keys_in_feed_and_upsert(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k long, v string")
    new = spark.createDataFrame([(None, "a"), (1, "x"), (3, "d")], "k long, v string")
    feed = sync.change_feed(old, new, ["k"])
    assert sorted((r.k, r.v, r._change_type) for r in feed.collect()) == [(1, "x", "update"), (2, "c", "delete"), (3, "d", "insert")]
    after = sync.upsert(old, spark.createDataFrame([(None, "z", "update"), (2, None, "delete"), (9, None, "delete")], "k long, v string, _change_type string"), ["k"])
    assert sorted(map(str, after.collect())) == sorted(map(str, old.filter("k = 1").union(spark.createDataFrame([(None, "z")], "k long, v string")).collect()))
    assert after._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_half_written_folder_is_built_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    os.remove(next(f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")))
    assert tables.ensure(spark, path, lambda: spark.range(7)).count() == 7
    assert tables.ensure(spark, path, lambda: spark.range(9)).count() == 7
