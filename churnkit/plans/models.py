"""Training, scoring and explanation over the feature table.

What a fit gives depends on its learner, so the queries return facts that SQL can state of any right fit: which rows were
held out and scored, that classes follow probabilities, that shares add up, that the loss on the training rows is no greater than that of
a constant. The label at hand is mostly a draw, so whether a fit finds a signal is asked of a label planted for it.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from churnkit.functions.columns import hash_uniform
from churnkit.operators import attribution as AT
from churnkit.operators import evaluate as E
from churnkit.operators import features as FT
from churnkit.operators import model as M
from churnkit.operators.boosting import BoostedTrees
from churnkit.plans import data as D
from churnkit.plans.registry import query
from churnkit.session import scratch_path
from churnkit.sources.tables import save

NAMES = FT.FEATURES


class _Workspace:
    """Feature table and fitted models over the tables of a folder as they are now."""

    def __init__(self, spark, d):
        self.spark = spark
        self.features = save(D.features(spark, d), scratch_path(spark, "features"))
        split = FT.stratified_split(self.features, ["customer_id"], "churned")
        self.train = split.filter(~F.col("is_test")).drop("is_test")
        self.test = split.filter("is_test").drop("is_test")
        self._models = {}

    def model(self, kind):
        if kind not in self._models:
            self._models[kind] = (M.fit_rf if kind == "forest" else M.fit_gbt)(self.train, NAMES, "churned")
        return self._models[kind]

    def scored(self, kind):
        """Held-out rows with probability and class."""
        got = M.score(self.model(kind), self.test, NAMES, ["customer_id", "churned"])
        return save(got.withColumn("model", F.lit(kind)), scratch_path(self.spark, "scored"))


def _stamp(spark, d):
    """Name, size and time of every file of the tables that features are made of."""
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    found = []
    for name in ("customer", "nation", "region", "orders", "lineitem", "events"):
        path = hadoop.Path(f"{d}/{name}.parquet")
        for s in path.getFileSystem(conf).listStatus(path):
            found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(found)


_KEPT: dict[tuple, _Workspace] = {}


def workspace(spark, d):
    """The last workspace, as long as the session and the files of the tables are the same."""
    key = (spark.sparkContext.applicationId, _stamp(spark, d))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = _Workspace(spark, d)
    return _KEPT[key]


_SPLIT = f"""WITH {D.FEATS}, held AS (SELECT *, {D.u("42|split", "customer_id")} < 0.2::DOUBLE AS is_test FROM feats),
n AS (SELECT count(*) FILTER (is_test) AS n, coalesce(sum(churned) FILTER (is_test), 0)::BIGINT AS positives FROM held)"""


# A label that one feature gives, with one in ten turned round: a draw of the key decides which.
PLANTED_SEED, PLANTED_NOISE, PLANTED_FITS = 9, 0.1, 20


def _planted(df):
    signal = (F.col("tier_rank") >= 2).cast("int")
    return df.withColumn("planted", F.when(hash_uniform(PLANTED_SEED, "customer_id") < PLANTED_NOISE, 1 - signal).otherwise(signal))


def _shape(model):
    """What makes a fit: its trees, without its name."""
    if isinstance(model, BoostedTrees):
        return [tuple(getattr(t, n).tobytes() for n in ("feature", "threshold", "left", "right", "missing_left", "value")) for t in model.trees]
    return model.stages[-1].toDebugString.partition("\n")[2]


def _fit_facts(spark, d, kind):
    w = workspace(spark, d)
    boosted = kind == "boosted"
    model = w.model(kind)
    n_trees, depth = ((len(model.trees), max(t.depth() for t in model.trees)) if boosted else
                      (model.stages[-1].getNumTrees, max(t.depth for t in model.stages[-1].trees)))
    facts = w.scored(kind).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("churned"), F.lit(0)).alias("positives"),
        F.count_if((F.col("probability") < 0) | (F.col("probability") > 1)).alias("outside"),
        F.count_if(F.col("prediction") != (F.col("probability") >= 0.5).cast("int")).alias("class_errors"))

    weighted = M.add_class_weight(w.train, "churned", "positive" if boosted else "balanced")
    own = M.score(model, weighted, NAMES, ["churned", "class_weight"])
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("probability")))
    loss = F.sum(F.col("class_weight") * -F.ln(F.when(F.col("churned") == 1, p).otherwise(1 - p))) / F.sum("class_weight")
    # both classes weigh the same, so the best constant is a half
    learns = own.agg((loss <= math.log(2) + 1e-9).alias("learns"))

    fit = (lambda t: M.fit_gbt(t, NAMES, "planted", rounds=PLANTED_FITS)) if boosted else (lambda t: M.fit_rf(t, NAMES, "planted", trees=PLANTED_FITS))
    train, test = _planted(w.train), _planted(w.test)
    first, second = fit(train), fit(train.repartition(7, "customer_id"))
    ranked = E.roc_auc(M.score(first, test, NAMES, ["customer_id", "planted"]), "planted", "probability").select((F.col("roc_auc") > 0.7).alias("finds_planted"))
    planted = test.agg(F.sum("planted").alias("planted"))
    return facts.join(learns).join(ranked).join(planted).select(
        F.lit(kind).alias("model"), "n", "positives", "outside", "class_errors", F.lit(n_trees).cast("long").alias("trees"),
        F.lit(depth <= (M.GBT_DEPTH if boosted else M.RF_DEPTH)).alias("depth_kept"), "learns",
        F.lit(_shape(first) == _shape(second)).alias("same_in_other_layout"), "planted", "finds_planted")


def _facts_sql(kind, trees):
    return _SPLIT + f""", planted AS (SELECT sum(CASE WHEN {D.u(PLANTED_SEED, "customer_id")} < {PLANTED_NOISE}::DOUBLE THEN (tier_rank < 2)::INT
  ELSE (tier_rank >= 2)::INT END)::BIGINT AS planted FROM held WHERE is_test)
SELECT '{kind}' AS model, n, positives, 0::BIGINT AS outside, 0::BIGINT AS class_errors, {trees}::BIGINT AS trees, true AS depth_kept,
  true AS learns, true AS same_in_other_layout, planted, true AS finds_planted FROM n, planted"""


@query(_facts_sql("forest", M.RF_TREES))
def f6_fit_random_forest(spark, d):
    """A forest of 200 trees: held-out rows scored, loss on the training rows, layout, and a planted signal found."""
    return _fit_facts(spark, d, "forest")


@query(_facts_sql("boosted", M.GBT_ROUNDS))
def f7_fit_boosted_trees(spark, d):
    """300 rounds of boosted trees: held-out rows scored, loss on the training rows, layout, and a planted signal found."""
    return _fit_facts(spark, d, "boosted")


@query(_SPLIT + """SELECT customer_id, true AS in_range, true AS class_follows FROM held WHERE is_test""")
def f8_score_batch(spark, d):
    """Every held-out customer, scored by key."""
    w = workspace(spark, d)
    got = M.score_batch(w.model("forest"), w.test, w.features, NAMES)
    return got.select("customer_id", F.col("probability").between(0, 1).alias("in_range"),
                      ((F.col("probability") >= 0.5).cast("int") == F.col("prediction")).alias("class_follows"))


@query(_SPLIT + """SELECT count(*) AS customers, sum(churned)::BIGINT AS churned, true AS shares_add_up FROM held WHERE is_test""")
def f9_probability(spark, d):
    """Held-out customers in ten bands of probability: the bands hold all of them, and both classes' shares add up to 1."""
    w = workspace(spark, d)
    p = w.model("forest").transform(w.test.select("churned", *[F.col(f).cast("double").alias(f) for f in NAMES]))
    both = p.select("churned", M.proba().alias("p"), M.proba("probability", 0).alias("q"))
    bands = both.groupBy(F.least(F.floor(F.col("p") * 10), F.lit(9)).alias("band")).agg(
        F.count("*").alias("n"), F.sum("churned").alias("churned"), F.max(F.abs(F.col("p") + F.col("q") - 1)).alias("off"))
    return bands.filter(F.col("band").between(0, 9)).agg(
        F.sum("n").alias("customers"), F.sum("churned").alias("churned"), (F.max("off") < 1e-9).alias("shares_add_up"))


@query(f"SELECT {len(NAMES)}::BIGINT AS n_features, {len(NAMES)}::INT AS last_rank, true AS adds_up, true AS none_negative, "
       "true AS ranked FROM (SELECT count(*) FROM customer)")
def f11_importances(spark, d):
    """Importances of all features: none negative, ranked, adding up to 1."""
    rows = M.importances(workspace(spark, d).model("forest"), spark, NAMES)
    later = rows.select(F.col("rank") - 1, F.col("importance")).toDF("rank", "next")
    return rows.join(later, "rank", "left").agg(
        F.count_distinct("feature").alias("n_features"), F.max("rank").alias("last_rank"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"), (F.min("importance") >= 0).alias("none_negative"),
        F.bool_and(F.coalesce(F.col("importance") >= F.col("next"), F.lit(True))).alias("ranked"))


@query(_SPLIT + f"SELECT customer_id, {len(NAMES)}::BIGINT AS features, true AS adds_up FROM held WHERE is_test")
def f12_shapley_values(spark, d):
    """Exact contributions of each feature to every held-out customer's score: they add up to the score minus the mean score of
    the background rows."""
    w = workspace(spark, d)
    model = w.model("forest")
    values = AT.tree_contributions(model, w.test, AT.background_rows(w.train, NAMES, "customer_id"), NAMES, "customer_id")
    total = values.groupBy("customer_id").agg(F.count("*").alias("features"), F.sum("contribution").alias("total"), F.max("expected").alias("expected"))
    scores = M.score(model, w.test, NAMES, ["customer_id"]).select("customer_id", "probability")
    off = F.abs(F.col("probability") - F.col("expected") - F.col("total"))
    return total.join(scores, "customer_id").select("customer_id", "features", (off < 1e-9).alias("adds_up"))
