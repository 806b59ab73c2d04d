"""Drift of a log as it arrives: closed windows become stored distributions, and each meets the one before it once."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnkit.operators.monitor import SERIES, bin_cells

_STATE = "last timestamp, bins array<string>, shares array<double>"
_ROWS = ("column_name string, drift_type string, window_start timestamp, window_end timestamp, model_version string, slice_key string, "
         "slice_value string, js_distance double")


def distribution_stream(log: DataFrame, ts: str, edges: Mapping[str, Sequence[float]], categorical: Sequence[str] = (),
                        version: str | None = None, slices: Sequence[str] = (), width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(window, series, bins) for each closed window of each series; bins are (bin, n) in order.

    Rows are counted by bin before they are shuffled, so a series with most of the rows sends a count per bin and task. State
    is a count per bin of each open window. A window is emitted once, when the watermark passes its end; rows that come
    later than ``late`` after the newest are dropped.
    """
    cells = bin_cells(log.withWatermark(ts, late), ts, edges, categorical, version, slices, width)
    counts = cells.groupBy("window", *SERIES, "bin").agg(F.count("*").alias("n"))
    return counts.groupBy("window", *SERIES).agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"))


def distance(p: Mapping[str, float], q: Mapping[str, float]) -> float:
    """Root of the Jensen-Shannon divergence in base 2; a bin that is absent has share 0."""
    total = 0.0
    for b in sorted(p.keys() | q.keys()):
        x, y = p.get(b, 0.0), q.get(b, 0.0)
        total += sum(v * math.log2(2 * v / (x + y)) for v in (x, y) if v > 0)
    return math.sqrt(min(1.0, max(0.0, total / 2)))


def drift_stream(closed: DataFrame) -> DataFrame:
    """Distance of each closed window from the window before it in its series, once.

    ``closed`` is a stream of the table that ``distribution_stream`` is written to. State is the last distribution of each
    series. Windows without rows are passed over, as in the batch form. A window that is not later than the last one of its
    series has been judged and gives nothing.
    """
    def judge(key, frames, state):
        import pandas as pd
        rows = sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: r.start)
        last, shares = None, {}
        if state.exists:
            last, bins, values = state.get
            last, shares = pd.Timestamp(last), dict(zip(bins, values, strict=True))
        out = []
        for r in rows:
            if last is not None and r.start <= last:
                continue
            total = int(sum(r.counts))
            now = {str(b): int(n) / total for b, n in zip(r.names, r.counts, strict=True)}
            if last is not None:
                out.append((key[3], "CONSECUTIVE", r.start, r.end, key[0], key[1], key[2], distance(now, shares)))
            last, shares = r.start, now
        if last is not None:
            state.update((last.to_pydatetime(), list(shares), list(shares.values())))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ROWS.split(", ")])

    flat = closed.select(*SERIES, F.col("window.start").alias("start"), F.col("window.end").alias("end"),
                         F.col("bins.bin").alias("names"), F.col("bins.n").alias("counts"))
    found = flat.groupBy(*SERIES).applyInPandasWithState(judge, _ROWS, _STATE, "append", "NoTimeout")
    return found.select("column_name", "drift_type", F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
                        *SERIES[:3], "js_distance")


def follow_drift(log: DataFrame, ts: str, edges: Mapping[str, Sequence[float]], root: str, available_now: bool = True,
                 **options) -> tuple[StreamingQuery, StreamingQuery]:
    """Keep ``root``/closed (distributions of closed windows) and ``root``/drift up to date from a stream of log rows.

    Two queries with checkpoints of their own below ``root``, each exactly once; the second reads what the first has
    committed. All windows that a batch closes are committed at once, so those of a series are met in order. With
    ``available_now`` both run until the input is used up.
    """
    spark = log.sparkSession

    def start(stream, name):
        writer = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoints/{name}"))
        return (writer.trigger(availableNow=True) if available_now else writer).start(f"{root}/{name}")

    windows = distribution_stream(log, ts, edges, **options)
    first = start(windows, "closed")
    if available_now:
        first.awaitTermination()
    second = start(drift_stream(spark.readStream.schema(windows.schema).parquet(f"{root}/closed")), "drift")
    if available_now:
        second.awaitTermination()
    return first, second
