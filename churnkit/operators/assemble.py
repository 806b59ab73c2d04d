"""Customer-360 assembly: rollups, latest row, lookups, membership, top-k.

All pieces are keyed by the customer, so the rollups' output partitioning is
reused by the joins that follow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.columns import ordinal, starts_with_any

MONEY = "decimal(18,2)"  # sums of money do not depend on the order of addition

# Defaults for customers without holdings, activity or risk rows.
CUSTOMER_DEFAULTS = {
    "num_products": 0, "total_balance_usd": 0.0, "num_deposit_products": 0, "has_maturing_cd": 0,
    "txn_count_60d": 0, "total_outflow_60d_usd": 0.0, "withdrawal_count_60d": 0,
    "attrition_risk_score": 0.0, "balance_outflow_30d_usd": 0.0,
}
TIER_RANKS = {"private": 3, "affluent": 2, "mass_affluent": 1}  # fixed values
DEPOSIT_PREFIXES = ("PROD-DEP",)  # fixed value
WITHDRAWAL_TYPES = ("withdrawal", "transfer_out")  # fixed values
RECENT_DAYS = 60  # fixed value


def money_sum(c: Column) -> Column:
    """Sum of an amount with two decimals, exact, as a double."""
    return F.sum(c.cast(MONEY)).cast("double")


def global_max(df: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery: no driver round trip."""
    return df.agg(F.max(column).alias("_max")).scalar()


def within_days(df: DataFrame, date_col: str, days: int, ref: Column | None = None) -> DataFrame:
    """Rows at most ``days`` days before the reference (default: the latest date)."""
    last = ref if ref is not None else global_max(df, date_col)
    return df.filter(F.col(date_col) >= F.date_sub(last.cast("date"), days))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should break ties.

    Each task keeps one candidate per key before the shuffle, so a hot key
    sends a handful of rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def holdings_agg(holdings: DataFrame, deposit_prefixes: Sequence[str] = DEPOSIT_PREFIXES,
                 key: str = "customer_id") -> DataFrame:
    """Per customer: holding rows, balance, deposit holdings, any open maturity.

    ``num_products`` counts holding rows, not distinct products.
    """
    maturing = F.col("maturity_date").isNotNull() & (F.col("status") == "active")
    return holdings.groupBy(key).agg(
        F.count("*").alias("num_products"),
        money_sum(F.col("balance_usd")).alias("total_balance_usd"),
        F.count_if(starts_with_any("product_id", deposit_prefixes)).alias("num_deposit_products"),
        F.max(maturing.cast("int")).alias("has_maturing_cd"))


def txn_agg(transactions: DataFrame, days: int = RECENT_DAYS, ref: Column | None = None,
            key: str = "customer_id") -> DataFrame:
    """Per customer over the last days: rows, sum of negative amounts, withdrawals."""
    outflow = F.when(F.col("amount_usd") < 0, F.col("amount_usd")).otherwise(F.lit(0.0))
    return within_days(transactions, "txn_date", days, ref).groupBy(key).agg(
        F.count("*").alias("txn_count_60d"),
        money_sum(outflow).alias("total_outflow_60d_usd"),
        F.count_if(F.col("txn_type").isin(*WITHDRAWAL_TYPES)).alias("withdrawal_count_60d"))


def customer_360(customers: DataFrame, holdings: DataFrame, transactions: DataFrame, risk: DataFrame,
                 tier_ranks: Mapping[str, int] = TIER_RANKS, deposit_prefixes: Sequence[str] = DEPOSIT_PREFIXES,
                 days: int = RECENT_DAYS, ref: Column | None = None,
                 risk_order: Sequence[Column] | None = None) -> DataFrame:
    """One row per customer with holdings, recent activity and latest risk.

    ``ref`` is the day the recency window ends; by default the latest risk
    snapshot.
    """
    key = "customer_id"
    as_of = ref if ref is not None else global_max(risk, "snapshot_date")
    order = risk_order or [F.desc("snapshot_date"), F.desc("attrition_risk_score"),
                           F.desc("balance_outflow_30d_usd")]
    latest = latest_by(risk, [key], order).select(key, "attrition_risk_score", "balance_outflow_30d_usd")
    return (customers.select(key, "tier", "tenure_years", "home_metro", "state", "annual_income_band")
            .join(latest, key, "left")
            .join(txn_agg(transactions, days, as_of), key, "left")
            .join(holdings_agg(holdings, deposit_prefixes), key, "left")
            .withColumn("tier_rank", ordinal("tier", tier_ranks))
            .fillna(CUSTOMER_DEFAULTS))


def dim_lookup(df: DataFrame, dim: DataFrame, key: str, column: str, default, dim_key: str | None = None,
               out: str | None = None) -> DataFrame:
    """Attribute of a dimension by key, or the default.

    No broadcast hint: Spark broadcasts the dimension when its size allows and
    shuffles otherwise.
    """
    out = out or column
    small = dim.select(F.col(dim_key or key).alias(key), F.col(column).alias("_attr"))
    return (df.join(small, key, "left").withColumn(out, F.coalesce("_attr", F.lit(default))).drop("_attr"))


def flag_members(df: DataFrame, key: str, members: DataFrame, out: str = "is_member") -> DataFrame:
    """Mark rows whose key is in the member table (duplicates allowed there)."""
    listed = members.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))
    return df.join(listed, key, "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(members.select(key), key, "left_semi")


def drop_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(members.select(key), key, "left_anti")


def expand_days(df: DataFrame, ref: Column, n: int, out: str = "day", offset: str = "day_offset") -> DataFrame:
    """Each row once per day: ``ref``, ``ref - 1`` ... ``n`` days in all."""
    return (df.withColumn(offset, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .withColumn(out, F.date_sub(ref, F.col(offset))))


def pair_with(df: DataFrame, values: Sequence, out: str) -> DataFrame:
    """Every row once per value of a short literal list, without a join."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(v) for v in values])))


def best_by(df: DataFrame, metric: str, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric."""
    return df.orderBy(F.desc_nulls_last(metric), *tie).limit(1)


def latest_preferred(df: DataFrame, kind: str, kinds: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row in ``order`` of the first kind in ``kinds`` that has any rows."""
    at = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col(kind))
    return df.filter(F.col(kind).isin(*kinds)).orderBy(at, *order).limit(1)


def top_at_risk(scored: DataFrame, value: str, k: int, key: str = "customer_id", prediction: str = "prediction",
                within: str | None = None) -> DataFrame:
    """Predicted churners with the highest value, overall or per group."""
    at_risk = scored.filter(F.col(prediction) == 1)
    order = [F.desc_nulls_last(value), F.col(key)]
    if within is None:
        return at_risk.orderBy(*order).limit(k)
    w = Window.partitionBy(within).orderBy(*order)
    return at_risk.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
