"""Digest feeds and the bucketed replica against plain comparison and plain upserts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from churnkit.session import scratch_path
from churnkit.sources import sync
from churnkit.sources import versions as V

DDL = "k long, v string, w double"


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_feed_equals_the_plain_one_and_reads_only_what_differs(spark):
    pick = random.Random(1)
    base = [(k, f"v{k}", k / 7) for k in range(400)] + [(None, "none", None)]
    for changes in (0, 3):
        touched = set(pick.sample(range(400), changes))
        after = [(k, None if k in touched and k % 3 == 0 else v + "!" if k in touched else v, w) for k, v, w in base if not (k in touched and k % 3 == 1)]
        after += [(5000 + k, "new", 1.0) for k in range(changes // 3)]
        old, new = spark.createDataFrame(base, DDL), spark.createDataFrame(after, DDL)
        a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
        V.save_version(old, ["k"], a, 32)
        V.save_version(new.repartition(3), ["k"], b, 32)
        want = sync.change_feed(old, new, ["k"])
        buckets = {r[0] for r in want.select(V.bucket_of(["k"], 32)).collect()}
        assert V.differing_buckets(spark, a, b) == sorted(buckets) and len(buckets) <= 6
        # the files of equal buckets are not there any more: they are not needed
        for p in (a, b):
            for name in os.listdir(f"{p.removeprefix('file://')}/rows"):
                if name.startswith("_bucket=") and int(name.split("=")[1]) not in buckets:
                    for f in os.listdir(f"{p}/rows/{name}"):
                        if not f.startswith("."):
                            open(f"{p}/rows/{name}/{f}", "wb").close()
        assert rows_of(V.version_feed(spark, a, b, old.schema, ["k"])) == rows_of(want)


def test_feed_of_empty_versions(spark):
    empty, some = spark.createDataFrame([], DDL), spark.createDataFrame([(1, "a", None)], DDL)
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    V.save_version(empty, ["k"], a)
    V.save_version(some, ["k"], b)
    assert [r._change_type for r in V.version_feed(spark, a, b, some.schema, ["k"]).collect()] == ["insert"]
    assert [r._change_type for r in V.version_feed(spark, b, a, some.schema, ["k"]).collect()] == ["delete"]
    assert V.version_feed(spark, a, a, some.schema, ["k"]).count() == 0


@pytest.mark.parametrize("compact_at", [2, 10])
def test_replica_equals_upserts(spark, compact_at):
    pick = random.Random(2)
    want = spark.createDataFrame([(k, f"v{k}", k / 3) for k in range(300)] + [(None, "n", None)], DDL)
    replica = V.Replica(spark, scratch_path(spark, "replica"), want.schema, ["k"], 8, compact_at)
    replica.create(want)
    state = {r[0]: tuple(r) for r in want.collect()}
    for number in range(1, 4):
        batch = {}
        for k in pick.sample([*range(350), None], 12):
            kind = "delete" if k in state and pick.random() < 0.3 else "update" if k in state else "insert"
            batch[k] = (k, f"b{number}", float(number), kind)
        changes = spark.createDataFrame(list(batch.values()), DDL + ", _change_type string")
        for again in range(2 if number == 2 else 1):  # a batch that is run again
            replica.apply(changes, number)
        for k, v, w, kind in batch.values():
            if kind == "delete":
                state.pop(k, None)
            else:
                state[k] = (k, v, w)
        assert rows_of(replica.read()) == sorted(map(str, state.values()))


def test_a_change_writes_its_own_buckets_only(spark):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.lit(1.0).alias("w"))
    root = scratch_path(spark, "replica")
    replica = V.Replica(spark, root, base.schema, ["k"], 8, 2)
    replica.create(base)
    change = lambda k: spark.createDataFrame([(k, "y", 2.0, "update")], DDL + ", _change_type string")
    parts = lambda folder: [n for n in os.listdir(f"{root}/{folder}") if n.startswith("_bucket=")]
    replica.apply(change(5), 1)
    assert len(parts("delta/1")) == 1 and not os.path.exists(f"{root}/base/1")
    replica.apply(change(5), 2)
    assert len(parts("base/2")) == 1 and len(parts("base/0")) == 8
    plan = replica.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # nothing is left to merge
    # without its manifest a batch has not happened
    replica.apply(change(6), 3)
    os.remove(f"{root}/manifest/3/_SUCCESS")
    assert replica.read().filter("k = 6").first().v == "x" and replica.read().count() == 1000
