"""Labels, bands, splits, class weights and the published feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.columns import hash_uniform
from churnkit.operators.order import draw_rank, quantiles
from churnkit.sources.tables import save

# The model's inputs and the columns the label is derived from.
BASE_FEATURES = [
    "tenure_years", "total_balance_usd", "num_products", "num_deposit_products", "has_maturing_cd",
    "txn_count_60d", "total_outflow_60d_usd", "withdrawal_count_60d", "tier_rank",
]
FEATURES = [*BASE_FEATURES, "balanceCategory"]
LABEL_SOURCES = ["attrition_risk_score", "balance_outflow_30d_usd"]

# Label rules.
RISK_LINE, RISK_PROB = 0.42, 0.85
BASE_PROB, OUTFLOW_STEP, TIER_STEP, MATURING_STEP = 0.06, 0.06, 0.03, 0.03


def churn_probability() -> Column:
    """Chance of leaving, from the latest risk or else from behaviour and tier."""
    def step(test, add):
        return F.when(test, F.lit(add)).otherwise(F.lit(0.0))

    behaviour = (F.lit(BASE_PROB) + step(F.col("total_outflow_60d_usd") < 0, OUTFLOW_STEP)
                 + step(F.col("tier_rank") >= 2, TIER_STEP) + step(F.col("has_maturing_cd") == 1, MATURING_STEP))
    return F.when(F.col("attrition_risk_score") >= RISK_LINE, F.lit(RISK_PROB)).otherwise(behaviour)


def churn_label(df: DataFrame, seed: int = 42, key: str = "customer_id", out: str = "churned") -> DataFrame:
    """Add the 0/1 label drawn per customer."""
    return df.withColumn(out, (hash_uniform(seed, key) < churn_probability()).cast("int"))


def quartile_band(df: DataFrame, column: str = "total_balance_usd", out: str = "balanceCategory",
                  cuts: Sequence[float] | None = None, approx: bool = False) -> DataFrame:
    """Band 0 at or below the first quartile, 1 between, 2 from the third up (and for nulls).

    Pass ``cuts`` to apply the quartiles of another table.
    """
    q1, q3 = cuts if cuts is not None else quantiles(df, column, [0.25, 0.75], approx=approx)
    c = F.col(column)
    if q1 is None:
        return df.withColumn(out, F.lit(2.0))
    return df.withColumn(out, F.when(c <= q1, 0.0).when(c < q3, 1.0).otherwise(2.0))


def select_features(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str,
                    forbidden: Sequence[str]) -> DataFrame:
    """Keys, features and label; refuses features the label was derived from."""
    leaking = sorted(set(features) & set(forbidden))
    if leaking:
        raise ValueError(f"label sources may not be features: {', '.join(leaking)}")
    missing = sorted(set([*keys, *features, label]) - set(df.columns))
    if missing:
        raise ValueError(f"columns not in the table: {', '.join(missing)}")
    return df.select(*keys, *[f for f in features if f != label], label)


def bad_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their row count."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | any_null)


def publish_features(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Write the feature table after checking that its keys are unique and not null."""
    first = bad_keys(df, keys).first()
    if first is not None:
        raise ValueError(f"feature table key is null or repeated: {first.asDict()}")
    return save(df, path)


def split_draw(keys: Sequence[str], seed: int = 42) -> Column:
    """The draw that decides a row's side. It is of the key alone: a row whose label changes stays on its side, so no
    held-out row is ever trained on later."""
    return hash_uniform(seed, F.lit("split"), *keys)


def stratified_split(df: DataFrame, keys: Sequence[str], label: str, test_share: float = 0.2, seed: int = 42,
                     exact: bool = False, out: str = "is_test") -> DataFrame:
    """Mark the held-out rows.

    By default each row's own draw decides: no shuffle, every caller with the
    same key and seed agrees, and classes are held out in about equal shares.
    ``exact`` holds out precisely ``round(share * n)`` rows of each class, by
    rank of the draw.
    """
    draw = split_draw(keys, seed)
    if not exact:
        return df.withColumn(out, draw < F.lit(test_share))
    ranked = draw_rank(df, draw, keys, by=[label], out="_rank")
    sizes = df.groupBy(label).agg(F.round(F.count("*") * test_share).cast("long").alias("_take"))
    cut = ranked.alias("r").join(sizes.alias("s"), F.col(f"r.{label}").eqNullSafe(F.col(f"s.{label}")))
    return cut.select(*[F.col(f"r.{c}").alias(c) for c in df.columns],
                      (F.col("r._rank") <= F.col("s._take")).alias(out))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, the balanced weight ``n / (classes * rows)`` and negatives per positive."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))  # over one row per class

    def of_class(k):
        return F.sum(F.when(F.col(label) == k, F.col("n")).otherwise(0)).over(every)

    return counts.withColumns({
        "balanced_weight": F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")),
        "neg_pos_ratio": F.round(of_class(0) / F.greatest(of_class(1), F.lit(1)), 3),
    })


def training_set(labels: DataFrame, features: DataFrame, names: Sequence[str], key: str, label: str,
                 keep_key: bool = False) -> DataFrame:
    """Labels with the named features looked up by key; every label row stays."""
    found = labels.select(key, label).join(features.select(key, *names), key, "left")
    return found if keep_key else found.drop(key)


def lookup(keys_df: DataFrame, features: DataFrame, names: Sequence[str], key: str,
           out: str = "is_matched") -> DataFrame:
    """Features for a list of keys, with a flag for keys the table does not have."""
    known = features.select(key, *names).withColumn("_hit", F.lit(True))
    return (keys_df.join(known, key, "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit"))
