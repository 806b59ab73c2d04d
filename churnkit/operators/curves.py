"""Areas under both curves from a score histogram that can be stored and added up, with proven bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096


def score_histogram(df: DataFrame, y: str, score: str, by: Sequence[str] = (), bins: int = BINS, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(by, bin, pos, n): rows and positives in bins of one width between ``low`` and ``high``.

    Scores beyond the ends, infinite ones too, fall into the end bins, NaN above all others as in an ordering; rows without a
    label or score do not count. One aggregation, pre-aggregated where rows are read: a group sends at most ``bins`` + 1 rows
    from a task.
    """
    s = F.col(score).cast("double")
    at = F.floor((F.greatest(F.lit(low), F.least(F.lit(high), s)) - low) / (high - low) * bins)
    number = F.when(F.isnan(s), F.lit(bins)).otherwise(F.least(F.lit(bins - 1), at)).cast("int")
    known = df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(*by, number.alias("bin")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count("*").alias("n"))


def add_histograms(histograms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored histograms of days or parts as that of all of them; equal to the histogram of all rows."""
    return histograms.groupBy(*by, "bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))


def curve_areas(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, pr_auc, pr_error, roc_auc, roc_error): each exact area lies within its error of its estimate, whatever the order and
    ties of scores inside bins.

    A positive outranks between none and all of the negatives of its own bin, which bounds the ROC area. For the other
    curve let a bin have p positives and m negatives below P positives in N rows. The i-th of them meets a step of at most
    (P + p) / (N + p), as if all its positives came first, and of at least f(i) = (P + i) / (N + m + i), as if all its
    negatives did; f is concave, so its sum is at least p (f(1) + f(p)) / 2. Ties only move a positive to a later step of
    its bin, which the bounds allow. The window orders at most one row for each bin of a group, with the totals from the same
    pass. One class alone: ``roc_auc`` is null and, without positives, ``pr_auc`` is 0 as in the exact form.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("bin"))
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    c = histogram.withColumns({"_P": F.coalesce(F.sum("pos").over(above), F.lit(0)).cast("double"),
                               "_N": F.coalesce(F.sum("n").over(above), F.lit(0)).cast("double")})
    p, n, before, rows = (F.col(x).cast("double") for x in ("pos", "n", "_P", "_N"))
    m = n - p

    def f(i):
        return F.try_divide(before + i, rows + m + i)

    least = F.when(p > 0, p * (f(F.lit(1.0)) + f(p)) / 2).otherwise(0.0)
    most = F.when(p > 0, p * (before + p) / (rows + p)).otherwise(0.0)
    # negatives of higher bins outrank the positives of this one
    lost = p * (rows - before)
    sums = c.groupBy(*by).agg(F.sum(p).alias("_p"), F.sum(m).alias("_m"), F.sum(least).alias("_least"), F.sum(most).alias("_most"),
                              F.sum(lost).alias("_lost"), F.sum(p * m).alias("_tied"))
    pairs = F.col("_p") * F.col("_m")
    mean = lambda a: F.coalesce(F.try_divide(a, F.col("_p")), F.lit(0.0))
    return sums.select(
        *by, mean((F.col("_least") + F.col("_most")) / 2).alias("pr_auc"), mean((F.col("_most") - F.col("_least")) / 2).alias("pr_error"),
        (1 - F.try_divide(F.col("_lost") + F.col("_tied") / 2, pairs)).alias("roc_auc"), F.try_divide(F.col("_tied") / 2, pairs).alias("roc_error"))
