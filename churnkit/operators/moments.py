"""Co-moments of many columns in one pass: counts, means and sums of products of every pair, merged as arrays.

A task folds its batches into one k x k table by matrix products and hands on a row for each column. Rows of one column meet in order
and are merged as they stream by, so neither a task nor the driver holds more than one table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# For each pair (i, j) over rows that have both: rows, rows with a value that is not finite, the means, and the sums of (x - mean x)^2,
# (y - mean y)^2 and (x - mean x)(y - mean y).
_PARTS = ["n", "bad", "mean_x", "mean_y", "xx", "yy", "xy"]


def batch_moments(x: np.ndarray, missing: np.ndarray) -> dict[str, np.ndarray]:
    """The seven tables of one batch of rows [rows, columns]."""
    here = ~missing
    odd = here & ~np.isfinite(x)
    good = here & ~odd
    # columns are moved by a value of their own, so that sums of large numbers do not hide small differences
    first = np.where(good.any(0), x[good.argmax(0), np.arange(x.shape[1])], 0.0)
    v = np.where(good, x - first, 0.0)
    m, both = good.astype(float), here.astype(float)
    n = m.T @ m
    with np.errstate(invalid="ignore", divide="ignore"):
        mean_x = np.where(n > 0, (v.T @ m) / n, 0.0)
    mean_y = mean_x.T
    square = (v * v).T @ m
    return {"n": n, "bad": both.T @ both - n, "mean_x": mean_x + first[:, None], "mean_y": mean_y + first[None, :],
            "xx": np.maximum(square - n * mean_x ** 2, 0.0), "yy": np.maximum(square.T - n * mean_y ** 2, 0.0), "xy": v.T @ v - n * mean_x * mean_y}


def merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The moments of two sets of rows together."""
    n = a["n"] + b["n"]
    share = np.divide(b["n"], n, out=np.zeros_like(n), where=n > 0)
    # a side without rows has no mean of its own
    dx = np.where((a["n"] > 0) & (b["n"] > 0), b["mean_x"] - a["mean_x"], 0.0)
    dy = np.where((a["n"] > 0) & (b["n"] > 0), b["mean_y"] - a["mean_y"], 0.0)
    w = a["n"] * share
    pick = lambda k, d: np.where(a["n"] > 0, a[k] + d * share, b[k])
    return {"n": n, "bad": a["bad"] + b["bad"], "mean_x": pick("mean_x", dx), "mean_y": pick("mean_y", dy),
            "xx": a["xx"] + b["xx"] + w * dx * dx, "yy": a["yy"] + b["yy"] + w * dy * dy, "xy": a["xy"] + b["xy"] + w * dx * dy}


def _row_batch(i: int, t: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([t[p].tolist()], pa.list_(pa.float64())) for p in _PARTS]], ["i", *_PARTS])


_SCHEMA = "i int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for each column ``i`` with arrays over all columns: the parts of ``_PARTS``. One scan, whatever the number of columns."""
    k = len(columns)
    doubles = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = np.column_stack([part.column(i).fill_null(0.0).to_numpy() for i in range(k)])
                missing = np.column_stack([part.column(i).is_null().to_numpy(zero_copy_only=False) for i in range(k)])
                own = batch_moments(x, missing)
                total = own if total is None else merge(total, own)
        if total is not None:
            for i in range(k):
                yield _row_batch(i, {p: total[p][i] for p in _PARTS})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for b in batches:
            for r in b.to_pylist():
                own = {p: np.array(r[p]) for p in _PARTS}
                if r["i"] == at:
                    held = merge(held, own)
                else:
                    if held is not None:
                        yield _row_batch(at, held)
                    held, at = own, r["i"]
        if held is not None:
            yield _row_batch(at, held)

    return doubles.mapInArrow(fold, _SCHEMA).repartition("i").sortWithinPartitions("i").mapInArrow(together, _SCHEMA)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, corr) for every pair of columns by place: Pearson correlation over rows that have both; null if one side is constant or
    no row has both, NaN if such a row has a value that is not finite."""
    moments = co_moments(df, columns)
    cells = moments.select("i", F.posexplode(F.arrays_zip(*[p for p in _PARTS if not p.startswith("mean")])).alias("j", "m")).select("i", "j", "m.*")
    corr = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    held = F.when(corr.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    return cells.select("i", "j", F.when(F.col("bad") > 0, F.lit(float("nan"))).otherwise(held).alias("corr"))
