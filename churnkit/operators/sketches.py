"""Sketches of a log kept as columns of a table: distinct values and quantiles that add up over days and slices.

Both kinds merge without loss: a sketch rolled up from stored parts is the sketch of all their rows, whatever the order.
Everything is a plain aggregation, so tasks pre-aggregate their rows and a group of any size sends a bounded number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.operators.monitor import _explode_cells

# 2^11 registers: the standard error of a distinct count is 1.04 / sqrt(2048), or 2.3 %.
REGISTER_BITS = 11
# A quantile is within this share of a value of that rank.
RELATIVE_ERROR = 0.01
# Buckets of positive values are numbered from here up, those of negative ones from here down, zero is bucket 0.
_OFFSET = 1_000_000


def bucket_of(value: Column, error: float = RELATIVE_ERROR) -> Column:
    """The bucket of a value, in the order of the values: each holds what lies within one factor of (1 + error) / (1 - error)."""
    step = F.ceil(F.log(F.abs(value)) / math.log((1 + error) / (1 - error))) + _OFFSET
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("long") * step).cast("long")


def bucket_value(bucket: Column, error: float = RELATIVE_ERROR) -> Column:
    """The value that is within ``error`` of all values of a bucket."""
    gamma = (1 + error) / (1 - error)
    size = F.pow(F.lit(gamma), F.abs(bucket) - _OFFSET) * (2 / (gamma + 1))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket) * size)


def _collected(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group from rows (group, kind, at, n, top, count, nulls, min, max): sparse registers and buckets in order."""
    def cells(kind, value):
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct(F.col("at").alias("at"), F.col(value).alias(value)))))

    return parts.groupBy(*group).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        cells("registers", "top").alias("registers"), cells("buckets", "n").alias("buckets"))


def _merged(cells: DataFrame, group: Sequence[str]) -> DataFrame:
    """Cells of one place as one: registers keep the greatest, buckets and counts add up."""
    return cells.groupBy(*group, "kind", "at").agg(
        F.sum("n").alias("n"), F.max("top").alias("top"), F.sum("count").alias("count"), F.sum("nulls").alias("nulls"),
        F.min("min").alias("min"), F.max("max").alias("max"))


def profile_sketches(log: DataFrame, columns: Sequence[str], ts: str, version: str = "model_version", slices: Sequence[str] = (),
                     width: str = "1 day", bits: int = REGISTER_BITS, error: float = RELATIVE_ERROR) -> DataFrame:
    """A row per window, version, slice and column: count, nulls, min, max, registers of distinct values, buckets of quantiles.

    The table to store for each day. Values that are null, NaN or infinite count as ``nulls``. Rows that leave a task are at
    most 2^bits registers and the buckets of the values' range for each group (about 115 for each factor of ten at 1 %).
    An empty log gives no rows.
    """
    v = F.col("v")
    start = F.window(F.col(ts), width)["start"].alias("window_start")
    group = ["window_start", version, "slice_key", "slice_value", "column_name"]
    numbers = {c: F.col(c).cast("double") for c in columns}
    finite = {c: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x) for c, x in numbers.items()}
    long = _explode_cells(log, [start, F.col(version)], slices, finite, "v")
    # adding zero makes -0.0 and 0.0 one value
    h = F.xxhash64(v + F.lit(0.0))
    rest = F.shiftrightunsigned(h, bits)
    # where the lowest one bit of the rest is, from 1
    rank = F.when(rest == 0, F.lit(65 - bits)).otherwise(F.bit_count(rest.bitwiseXOR(rest - 1)))
    none = F.lit(None)
    cells = F.array(
        F.struct(F.lit("buckets").alias("kind"), bucket_of(v, error).alias("at"), F.lit(1).cast("long").alias("n"), none.cast("int").alias("top")),
        F.struct(F.lit("registers").alias("kind"), h.bitwiseAND(F.lit((1 << bits) - 1)).alias("at"), none.cast("long").alias("n"),
                 rank.cast("int").alias("top")))
    met = long.select(*group, "v", F.explode(cells).alias("_cell")).filter(v.isNotNull() | (F.col("_cell.kind") == "buckets"))
    own = F.col("kind") == "buckets"
    flat = met.select(*group, "_cell.*", "v").select(
        *group, F.when(v.isNull(), F.lit("nulls")).otherwise(F.col("kind")).alias("kind"), "at", F.when(v.isNotNull(), F.col("n")).alias("n"), "top",
        F.when(own, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("count"), v.isNull().cast("long").alias("nulls"),
        v.alias("min"), v.alias("max"))
    return _collected(_merged(flat, group), group)


def roll_up(sketches: DataFrame, keep: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """Stored sketches as those of larger groups: ``keep`` names the columns that stay, or gives what they become (a week of
    a day, no slice). The log is not read. Equal to the sketches of all the rows; slices of one row must not be added up."""
    kept = dict(keep) if isinstance(keep, Mapping) else {k: F.col(k) for k in keep}
    null = lambda t: F.lit(None).cast(t)

    def cell(kind, at, n, top, count, nulls, low, high):
        return F.struct(kind.alias("kind"), at.alias("at"), n.alias("n"), top.alias("top"), count.alias("count"), nulls.alias("nulls"),
                        low.alias("min"), high.alias("max"))

    zero = F.lit(0).cast("long")
    cells = F.concat(
        F.array(cell(F.lit("counts"), null("long"), null("long"), null("int"), F.col("count"), F.col("nulls"), F.col("min"), F.col("max"))),
        F.transform("registers", lambda r: cell(F.lit("registers"), r["at"], null("long"), r["top"], zero, zero, null("double"), null("double"))),
        F.transform("buckets", lambda b: cell(F.lit("buckets"), b["at"], b["n"], null("int"), zero, zero, null("double"), null("double"))))
    rows = sketches.select(*[e.alias(k) for k, e in kept.items()], F.explode(cells).alias("_cell")).select(*kept, "_cell.*")
    return _collected(_merged(rows, list(kept)), list(kept))


def distinct_estimate(registers: str = "registers", bits: int = REGISTER_BITS) -> Column:
    """About how many distinct values there are: counting of empty registers while there are many, else the harmonic mean."""
    m = float(1 << bits)
    empty = F.lit(m) - F.size(registers)
    total = F.aggregate(registers, F.lit(0.0), lambda a, r: a + F.pow(F.lit(2.0), -r["top"])) + empty
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / total
    return F.when((raw <= 2.5 * m) & (empty > 0), F.lit(m) * F.log(F.lit(m) / empty)).otherwise(raw)


def quantile_estimate(prob: float, buckets: str = "buckets", error: float = RELATIVE_ERROR) -> Column:
    """A value within ``error`` of the value of rank ceil(prob * n), at least the first; null without values."""
    n = F.aggregate(buckets, F.lit(0).cast("long"), lambda a, b: a + b["n"])
    wanted = F.greatest(F.lit(1).cast("long"), F.ceil(n * F.lit(float(prob))))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))

    def step(a, b):
        seen = a["seen"] + b["n"]
        return F.struct(seen.alias("seen"), F.when(a["at"].isNull() & (seen >= wanted), b["at"]).otherwise(a["at"]).alias("at"))

    return bucket_value(F.aggregate(buckets, start, step)["at"], error)
