"""Column builders: keyed draws, picks, keys, dates, encodings, outcomes.

Everything here is a plain expression, evaluated where the row is. Randomness
comes from a hash of the row's key, so a value never depends on partitioning,
on retries or on which job computes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAW_RANGE = 4294967296.0  # fixed value: 2^32, the span of eight hex digits


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# --- keyed draws -----------------------------------------------------------

def hash_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform draw in [0, 1) fixed by the seed and the row's key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(DRAW_RANGE)


def pick(values: Sequence, u: Column) -> Column:
    """One of ``values`` with equal probability."""
    options = F.array(*[_lit(v) for v in values])
    return F.element_at(options, F.floor(u * len(values)).cast("int") + 1)


def pick_weighted(choices: Sequence[tuple], u: Column) -> Column:
    """One of ``(value, weight)`` by cumulative weight; the last takes the rest."""
    total = float(sum(w for _, w in choices))
    expr, upto = None, 0.0
    for value, weight in choices[:-1]:
        upto += weight / total
        test = u < F.lit(round(upto, 12))
        expr = F.when(test, _lit(value)) if expr is None else expr.when(test, _lit(value))
    last = _lit(choices[-1][0])
    return last if expr is None else expr.otherwise(last)


def uniform_amount(lo: float, span: float, u: Column, digits: int = 2) -> Column:
    """``lo + u * span`` rounded; a negative span walks down from ``lo``."""
    return F.round(F.lit(float(lo)) + u * F.lit(float(span)), digits)


def uniform_int(lo: int, span: int, u: Column) -> Column:
    """Integer in ``lo .. lo + span - 1``."""
    return F.floor(F.lit(lo) + u * F.lit(span)).cast("int")


def date_draw(ref: Column, span: int, u: Column, offset: int = 0, forward: bool = False) -> Column:
    """Date ``offset .. offset + span - 1`` days before (or after) ``ref``."""
    days = F.floor(u * span).cast("int") + F.lit(offset)
    return F.date_add(ref, days) if forward else F.date_sub(ref, days)


# --- keys and text -----------------------------------------------------------

def make_key(prefix: str, number: Column | str, width: int) -> Column:
    """``prefix`` plus the number padded with zeros.

    A number longer than ``width`` keeps all its digits, so keys stay unique.
    """
    digits = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def surrogate_key(*natural: Column | str) -> Column:
    """128-bit id from the natural key: narrow, repeatable, same in every job."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in natural]
    return F.md5(F.concat_ws("\u0001", *parts))


# --- encodings, status, defaults ----------------------------------------------

def ordinal(column: Column | str, ranks: Mapping, default: int = 0) -> Column:
    """Rank of a category; unknown and null categories get ``default``."""
    c, expr = _col(column), None
    for value, rank in ranks.items():
        expr = F.when(c == F.lit(value), F.lit(rank)) if expr is None else expr.when(c == F.lit(value), F.lit(rank))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def maturity_status(maturity: Column | str, as_of: Column) -> Column:
    """``matured`` when the maturity date lies before ``as_of``, else ``active``."""
    m = _col(maturity)
    return F.when(m.isNotNull() & (m < as_of), F.lit("matured")).otherwise(F.lit("active"))


def first_known(*columns: Column | str, default=None) -> Column:
    """First non-null of the columns, else the default."""
    return F.coalesce(*[_col(c) for c in columns], _lit(default))


def starts_with_any(column: Column | str, prefixes: Sequence[str]) -> Column:
    """True when the text begins with one of the prefixes."""
    test = F.lit(False)
    for p in prefixes:
        test = test | _col(column).startswith(p)
    return test


# --- scenario and time shifts ---------------------------------------------------

# The default stress scenario, column -> rule.
PROMO_SCENARIO = {
    "total_outflow_60d_usd": ("affine", 3.5, -50000.0),
    "total_balance_usd": ("affine", 1.6, 0.0),
    "has_maturing_cd": ("constant", 1),
    "tier_rank": ("floor_add", 1, 1),
    "withdrawal_count_60d": ("affine", 1, 8),
    "txn_count_60d": ("affine", 1, 5),
}


def scenario_shift(df: DataFrame, rules: Mapping = PROMO_SCENARIO, key: str | None = "customer_id",
                   key_from: str = "CUST-", key_to: str = "CUST-D-") -> DataFrame:
    """Shifted copy of a cohort: affine, constant or floor-then-add per column."""
    def shifted(name, rule):
        c = F.col(name)
        if rule[0] == "affine":
            return c * F.lit(rule[1]) + F.lit(rule[2])
        if rule[0] == "constant":
            return F.lit(rule[1])
        if rule[0] == "floor_add":
            return F.greatest(c, F.lit(rule[1])) + F.lit(rule[2])
        raise ValueError(f"unknown rule {rule[0]!r} for {name}")

    out = {name: shifted(name, rule) for name, rule in rules.items() if name in df.columns}
    if key:
        out[key] = F.replace(F.col(key), F.lit(key_from), F.lit(key_to))
    return df.withColumns(out)


def shift_time(df: DataFrame, column: str, interval: str) -> DataFrame:
    """Move rows back in time, e.g. ``shift_time(df, "ts", "3 DAYS")``."""
    return df.withColumn(column, F.col(column) - F.expr(f"INTERVAL {interval}"))
