"""Cutting a table into ranges of an integer key with about equal weight, the same way on every run."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ranges:
    """Range i holds keys from ``starts[i]`` to before ``starts[i + 1]``; null keys are in range 0. ``totals`` are weights."""

    starts: list[int]
    totals: list[int]

    def find(self, keys: list[int | None]) -> np.ndarray:
        """The range of each key."""
        known = np.array([self.starts[0] if k is None else k for k in keys], np.int64)
        found = np.maximum(np.searchsorted(np.array(self.starts, np.int64), known, "right") - 1, 0)
        found[np.array([k is None for k in keys], bool)] = 0
        return found


def plan_ranges(df: DataFrame, key: str, weight: str, target: int) -> Ranges:
    """Ranges of the integer ``key`` whose summed ``weight`` stays near ``target``.

    Key space is cut into equal cells, of which weights are summed map-side; a cell heavier than the target is cut again,
    all of them in one more pass, until it is light or holds a single key. Neighbouring light cells are joined. What the
    driver gets is in proportion to the number of ranges, and depends on nothing but the rows: neither on a sample nor on
    partitions. Ranges are exact: a single key heavier than the target is a range of its own. An empty table has one range.
    """
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(weight).cast("long").alias("w"))
    low, high, total, nulls = rows.agg(
        F.min("k"), F.max("k"), F.coalesce(F.sum("w"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("w"))), F.lit(0))).first()
    if low is None:
        return Ranges([0], [total])
    cells = max(16, 4 * (total // target + 1))
    done: list[tuple[int, int]] = []  # (first key, weight)
    width = -(-(high - low + 1) // cells)
    rows = rows.where("k is not null").withColumn("cell", F.expr(f"k div {width}L"))
    heavy = None
    while heavy is None or heavy:
        if heavy:
            # one row per heavy cell, each found by its number
            cuts = [(cell, i * (cells + 1), a, -(-(b - a + 1) // cells)) for i, (cell, a, b) in enumerate(heavy)]
            frame = df.sparkSession.createDataFrame(cuts, "cell long, base long, a long, width long")
            rows = rows.join(frame, "cell").select("k", "w", F.expr("base + (k - a) div width").alias("cell"))
        found = rows.groupBy("cell").agg(F.sum("w").alias("w"), F.min("k").alias("a"), F.max("k").alias("b")).collect()
        heavy = [(r.cell, r.a, r.b) for r in found if r.w > target and r.a < r.b]
        done += [(r.a, r.w) for r in found if not (r.w > target and r.a < r.b)]
    done.sort()
    starts, totals = [low], [nulls]
    for first, w in done:
        if totals[-1] and totals[-1] + w > target:
            starts.append(first)
            totals.append(0)
        totals[-1] += w
    return Ranges(starts, totals)
