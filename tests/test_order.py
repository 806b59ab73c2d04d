import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnkit.functions.columns import hash_uniform
from churnkit.operators import order as O

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """One value holds a third of the rows, one group two thirds; nulls included."""
    rnd = random.Random(3)
    rows = [("big" if i % 3 else "small", 7.0 if i % 3 == 1 else round(rnd.gauss(0, 50), 2), None if i % 11 == 0 else i % 5)
            for i in range(3000)]
    return spark.createDataFrame(rows, "g string, v double, w int").cache()


# brackets; shared cut points
WAYS = [{}, {"max_groups": 0}]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("accuracy,ranges", [(2000, 7), (10, 2), (3, 64)])
def test_linear_quantiles_equal_pandas(skewed, monkeypatch, way, accuracy, ranges):
    monkeypatch.setattr(O, "SKETCH_ACCURACY", accuracy)
    pdf = skewed.toPandas()
    got = O.exact_quantiles(skewed, ["v", "w"], PROBS, ["g"], ranges=ranges, **way).collect()
    assert len(got) == 2 * 2 * len(PROBS)
    for r in got:
        want = pdf[pdf.g == r.g][r.column].quantile(r.prob)
        assert r.value == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("way", WAYS)
def test_discrete_quantiles_are_elements(spark, skewed, way):
    got = {r.prob: r.value for r in O.exact_quantiles(skewed, ["v"], PROBS, method="discrete", **way).collect()}
    want = skewed.approxQuantile("v", PROBS, 0.0)
    assert [got[p] for p in PROBS] == want


def test_quantiles_with_null_group_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", float("nan")), ("b", None)], "g string, v double")
    for way in WAYS:
        got = {(r.g, r.prob): r.value for r in O.exact_quantiles(df, ["v"], [0.5], ["g"], **way).collect()}
        assert got == {(None, 0.5): 2.0, ("a", 0.5): 5.0}
    assert O.exact_quantiles(df.limit(0), ["v"], [0.5]).count() == 0
    assert O.quantiles(df.limit(0), "v", [0.5]) == [None]


def test_quantiles_of_extremes(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf,), (0.0,), (1.0,), (inf,)], "v double")
    got = {r.prob: r.value for r in O.exact_quantiles(df, ["v"], [0.0, 0.3, 0.6, 1.0], method="discrete").collect()}
    assert got == {0.0: -inf, 0.3: 0.0, 0.6: 1.0, 1.0: inf}


def test_both_ways_give_the_same_digits(skewed):
    ways = [sorted(map(tuple, O.exact_quantiles(skewed, ["v", "w"], [0.1, 1 / 3, 0.77], ["g"], **way).collect())) for way in WAYS]
    assert ways[0] == ways[1] and len(ways[0]) == 12


def test_quantiles_of_a_nan_group(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("nan"), 3.0), (None, 4.0), (2.0, 5.0)], "g double, v double")
    for way in WAYS:
        got = {str(r.g): r.value for r in O.exact_quantiles(df, ["v"], [0.5], ["g"], **way).collect()}
        assert got == {"nan": 2.0, "None": 4.0, "2.0": 5.0}


def test_draw_rank_is_a_row_number(spark, shuffle_parts):
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, "big").otherwise("small"))
    runs = shuffle_parts(lambda: O.draw_rank(df, hash_uniform(1, "id"), ["id"], ["g"]))
    assert runs[0] == runs[1] == runs[2]
    got = O.draw_rank(df, hash_uniform(1, "id"), ["id"], ["g"]).toPandas()
    for g, n in (("big", 400), ("small", 100)):
        assert sorted(got[got.g == g]["rank"]) == list(range(1, n + 1))


def _draw(key, seed=42):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("ranges", [2, 5, 64])
def test_value_rank_with_hot_value_and_nulls(spark, ranges):
    """Half of the rows share one value and some have none."""
    rows = [(i, None if i % 9 == 0 else 2.0 if i % 2 else float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double").repartition(3)
    got = [r.id for r in O.value_rank(df, "v", ["id"], ranges=ranges).orderBy("rank").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, _draw(r[0]), r[0]))]


def test_value_rank_splits_a_hot_value(spark):
    """The rows of one value are ordered in many groups, not in one."""
    df = spark.range(4000).withColumn("v", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")))
    seen = {}
    real = O._number_rows

    def spy(ranged, *args):
        seen["largest"] = ranged.groupBy("_rng").count().agg(F.max("count")).first()[0]
        return real(ranged, *args)

    O._number_rows, ranked = spy, None
    try:
        ranked = O.value_rank(df, "v", ["id"], ranges=64)
    finally:
        O._number_rows = real
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 4001))
    assert seen["largest"] < 4000 / 64 * 3


def test_value_rank_of_large_integers(spark):
    """Integers that one double stands for keep their order, hot ones too."""
    top = 2**54
    rows = [(i, top + (i * 7) % 2 if i % 3 else i) for i in range(2000)]
    got = O.value_rank(spark.createDataFrame(rows, "id long, v long"), "v", ["id"], ranges=64).orderBy("rank").collect()
    assert [r.v for r in got] == sorted(v for _, v in rows)


def test_value_rank_of_infinities_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [nan, inf, -inf, None, float(i)][i % 5]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v double")
    seen = {}
    real = O._number_rows

    def spy(ranged, *args):
        seen["largest"] = ranged.groupBy("_rng").count().agg(F.max("count")).first()[0]
        return real(ranged, *args)

    O._number_rows = spy
    try:
        got = [str(r.v) for r in O.value_rank(df, "v", ["id"], ranges=64).orderBy("rank").collect()]
    finally:
        O._number_rows = real
    assert got == ["None"] * 400 + ["-inf"] * 400 + [str(float(i)) for i in range(4, 2000, 5)] + ["inf"] * 400 + ["nan"] * 400
    assert seen["largest"] < 40


def test_running_counts_with_infinity(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (float("inf"),), (float("-inf"),)], "s double")
    got = {r.s: r.n_upto for r in O.running_counts(df, "s", {"n": F.count("*")}).collect()}
    assert got == {float("inf"): 1, 1.0: 2, 0.0: 3, float("-inf"): 4}


def test_running_counts(spark, shuffle_parts):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "m string, s double, y int")
    run = lambda: O.running_counts(df, "s", {"pos": F.sum("y"), "n": F.count("*")}, ["m"])
    runs = shuffle_parts(run)
    assert runs[0] == runs[1] == runs[2]
    pdf = pd.DataFrame(rows, columns=["m", "s", "y"])
    for r in run().collect():
        above = pdf[(pdf.m == r.m) & (pdf.s >= r.s)]
        assert (r.pos_upto, r.n_upto) == (above.y.sum(), len(above))
