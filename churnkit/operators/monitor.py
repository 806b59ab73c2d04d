"""Monitoring of an inference log: windowed profiles, drift, quality, gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators.order import exact_quantiles, same_keys
from churnkit.operators.profile import bin_edges, bin_index

DRIFT_KINDS = ("CONSECUTIVE", "BASELINE", "SEQUENTIAL")  # fixed values, in order of preference
ALL = "all"  # slice label of rows that are not sliced


def time_window(df: DataFrame, ts: str, width: str = "1 day", out: str = "window") -> DataFrame:
    """Tumbling window of each row by event time; a struct of start and end."""
    return df.withColumn(out, F.window(F.col(ts), width))


def slice_labels(slices: Sequence[str]) -> list[tuple[Column, Column]]:
    """Key and value of the overall slice and of each row's own slices."""
    own = [(F.lit(s), F.coalesce(F.col(s).cast("string"), F.lit("null"))) for s in slices]
    return [(F.lit(ALL), F.lit(ALL)), *own]


def _explode_cells(df: DataFrame, keep: Sequence[Column], slices: Sequence[str], values: Mapping[str, Column],
                   out: str) -> DataFrame:
    """One row per slice and column: ``keep``, slice_key, slice_value, column_name, ``out``.

    Rows are repeated map-side, as grouping sets would do, and are meant to go
    straight into a partial aggregation.
    """
    cells = [F.struct(k.alias("slice_key"), v.alias("slice_value"), F.lit(c).alias("column_name"), e.alias(out))
             for k, v in slice_labels(slices) for c, e in values.items()]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_cell")).select("*", "_cell.*").drop("_cell")


def profile_metrics(log: DataFrame, columns: Sequence[str], ts: str, version: str = "model_version",
                    slices: Sequence[str] = (), width: str = "1 day", quantiles: Mapping[str, float] | None = None,
                    exact: bool = False) -> DataFrame:
    """Count, nulls, mean, deviation, ends, distinct values per window, version, slice and column.

    All of it is one aggregation, merged map-side: distinct counts and quantiles
    are sketches of bounded size. ``exact`` shuffles the values themselves, once
    per slice they are in.
    """
    keep = ["window_start", version]
    start = F.window(F.col(ts), width)["start"].alias("window_start")
    long = _explode_cells(log, [start, F.col(version)], slices, {c: F.col(c).cast("double") for c in columns}, "v")
    group = [*keep, "slice_key", "slice_value", "column_name"]
    out = long.groupBy(*group).agg(
        F.count("*").alias("count"), F.count_if(F.col("v").isNull()).alias("nulls"), F.avg("v").alias("mean"),
        F.stddev("v").alias("stddev"), F.min("v").alias("min"), F.max("v").alias("max"),
        (F.count_distinct("v") if exact else F.approx_count_distinct("v")).alias("distinct_count"))
    if not quantiles:
        return out
    if exact:
        rows = exact_quantiles(long, ["v"], sorted(set(quantiles.values())), group)
        q = rows.groupBy(*group).agg(*[
            F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for n, p in quantiles.items()])
    else:
        q = long.groupBy(*group).agg(*[F.percentile_approx("v", p, 10000).alias(n) for n, p in quantiles.items()])
    return out.alias("p").join(q.alias("q"), same_keys("p", "q", group), "left").select(
        "p.*", *[F.col(f"q.{n}").alias(n) for n in quantiles])


def numeric_edges(df: DataFrame, columns: Sequence[str], bins: int = 10, approx: bool = False) -> dict[str, list[float]]:
    """Shared bin edges per column, from the whole log or from a baseline table."""
    return {c: bin_edges(df, c, bins, approx) for c in columns}


SERIES = ["model_version", "slice_key", "slice_value", "column_name"]


def bin_cells(log: DataFrame, ts: str, edges: Mapping[str, Sequence[float]], categorical: Sequence[str] = (),
              version: str | None = None, slices: Sequence[str] = (), width: str = "1 day") -> DataFrame:
    """One row per log row, slice and column: window, model_version, slice_key, slice_value, column_name, bin."""
    def label(c):
        if c in categorical:
            return F.coalesce(F.col(c).cast("string"), F.lit("null"))
        e = edges[c]
        if not e:
            return F.lit("null")
        clipped = F.greatest(F.lit(e[0]), F.least(F.lit(e[-1]), F.col(c).cast("double")))
        return F.when(F.col(c).isNull(), "null").otherwise(bin_index(clipped, e).cast("string"))

    v = F.col(version).cast("string") if version else F.lit(ALL)
    return _explode_cells(log, [F.window(F.col(ts), width).alias("window"), v.alias("model_version")], slices,
                          {c: label(c) for c in [*edges, *categorical]}, "bin")


def distributions(log: DataFrame, ts: str, edges: Mapping[str, Sequence[float]], categorical: Sequence[str] = (),
                  version: str | None = None, slices: Sequence[str] = (), width: str = "1 day") -> DataFrame:
    """Share of each bin per window: numeric bins on shared edges, categories by value.

    Rows: window_start, model_version, slice_key, slice_value, column_name,
    bin, n, share. Values below or above the edges fall into the end bins;
    nulls have their own bin. Empty bins have no row: the drift functions treat
    a missing bin as share 0.
    """
    long = bin_cells(log, ts, edges, categorical, version, slices, width)
    group = ["window_start", *SERIES]
    long = long.withColumn("window_start", F.col("window.start"))
    counts = long.groupBy(*group, "bin").agg(F.count("*").alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_total"))
    return counts.join(totals, group).withColumn("share", F.col("n") / F.col("_total")).drop("_total")


def _js(pairs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Distance from rows ``group, bin, p, q``: root of the Jensen-Shannon divergence, base 2."""
    shares = pairs.groupBy(*group, "bin").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    m = (F.col("p") + F.col("q")) / 2

    def part(x):
        return F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(F.lit(0.0))

    jsd = (F.sum(part("p")) + F.sum(part("q"))) / 2
    return shares.groupBy(*group).agg(
        F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), jsd))).alias("js_distance"))


def _drift_rows(js: DataFrame, kind: str, width: str) -> DataFrame:
    end = F.col("window_start") + F.expr(f"INTERVAL {width}")
    return js.select("column_name", F.lit(kind).alias("drift_type"),
                     F.struct(F.col("window_start").alias("start"), end.alias("end")).alias("window"),
                     "model_version", "slice_key", "slice_value", "js_distance")


def drift_consecutive(dist: DataFrame, width: str = "1 day") -> DataFrame:
    """Distance of each window from the window before it in the same series.

    Every share is emitted twice, as its own window's and as the next window's
    previous one; summing per bin lines the two up and fills absent bins with 0.
    ``dist`` is read twice: pass the stored table rather than its plan.
    """
    windows = dist.select(*SERIES, "window_start").distinct()
    w = Window.partitionBy(*SERIES).orderBy("window_start")
    around = windows.withColumns({"_next": F.lead("window_start").over(w),
                                  "_has_prev": F.lag("window_start").over(w).isNotNull()})
    both = dist.join(around, [*SERIES, "window_start"])
    sides = F.array(
        F.struct(F.when(F.col("_has_prev"), F.col("window_start")).alias("window_start"),
                 F.col("share").alias("p"), F.lit(0.0).alias("q")),
        F.struct(F.col("_next").alias("window_start"), F.lit(0.0).alias("p"), F.col("share").alias("q")))
    pairs = (both.select(*SERIES, "bin", F.explode(sides).alias("_x")).select(*SERIES, "bin", "_x.*")
             .filter(F.col("window_start").isNotNull()))
    return _drift_rows(_js(pairs, [*SERIES, "window_start"]), "CONSECUTIVE", width)


def baseline_shares(df: DataFrame, edges: Mapping[str, Sequence[float]], categorical: Sequence[str] = ()) -> DataFrame:
    """Bin shares of a baseline table with the log's columns: column_name, bin, share."""
    stamped = df.withColumn("_ts", F.lit("2000-01-01").cast("timestamp"))
    return distributions(stamped, "_ts", edges, categorical).select("column_name", "bin", "share")


def drift_baseline(dist: DataFrame, baseline: DataFrame, width: str = "1 day") -> DataFrame:
    """Distance of each window from the baseline's shares.

    Each bin of a window meets its own bin of the baseline. Bins of the baseline that a window lacks need no row: each adds
    its whole share to the divergence, so together they add what the bins that were met leave of the column's total.
    """
    group = [*SERIES, "window_start"]
    p, q = F.col("share"), F.coalesce("_q", F.lit(0.0))

    def part(x):
        return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))

    base = baseline.groupBy("column_name", "bin").agg(F.sum("share").alias("_q"))
    totals = base.groupBy("column_name").agg(F.sum("_q").alias("_total"))
    met = dist.join(base, ["column_name", "bin"], "left").groupBy(*group).agg(
        F.sum(part(p) + part(q)).alias("_both"), F.sum(q).alias("_met"))
    jsd = (F.col("_both") + F.greatest(F.lit(0.0), F.coalesce("_total", F.lit(0.0)) - F.col("_met"))) / 2
    # one row per column on the right
    js = met.join(totals, "column_name", "left").select(
        *group, F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), jsd))).alias("js_distance"))
    return _drift_rows(js, "BASELINE", width)


def drift_view(drift: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drift rows of some columns: the features, or the prediction."""
    return drift.filter(F.col("column_name").isin(*columns))


def schema_changes(df: DataFrame, expected: T.StructType) -> list[tuple[str, str]]:
    """Columns that are missing, new or of another type than expected."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in expected.fields}
    out = [(c, "missing") for c in want if c not in have]
    out += [(c, "added") for c in have if c not in want]
    return sorted(out + [(c, f"{want[c]} -> {have[c]}") for c in want if c in have and have[c] != want[c]])


def quality_checks(log: DataFrame, columns: Sequence[str], ts: str, width: str = "1 day", z_limit: float = 3.0,
                   expected: T.StructType | None = None) -> DataFrame:
    """Per window and column: null rate and its change, rows and their z-score against earlier windows.

    ``expected`` is the schema the log should have. A profiled column of another type says so in every row; columns that are
    missing, new or changed but not profiled have a row of their own without a window.
    """
    wide = log.groupBy(F.window(F.col(ts), width)["start"].alias("window_start")).agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns])
    long = wide.select("window_start", "rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("nulls")) for c in columns])).alias("_x")).select(
        "window_start", "rows", "_x.*")
    w = Window.partitionBy("column_name").orderBy("window_start")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    rate = F.col("nulls") / F.col("rows")
    z = F.try_divide(F.col("rows") - F.avg("rows").over(earlier), F.stddev("rows").over(earlier))
    out = long.withColumn("null_rate", rate).withColumns({
        "null_rate_change": F.col("null_rate") - F.lag("null_rate").over(w),
        "volume_z": z}).withColumn("volume_anomaly", F.coalesce(F.abs("volume_z") > z_limit, F.lit(False)))
    changed = schema_changes(log, expected) if expected is not None else []
    notes = F.create_map(*[x for c, note in changed for x in (F.lit(c), F.lit(note))]) if changed else None
    note = F.try_element_at(notes, F.col("column_name")) if changed else F.lit(None).cast("string")
    out = out.withColumn("schema_change", note)
    rest = [(c, n) for c, n in changed if c not in columns]
    if not rest:
        return out
    extra = log.sparkSession.createDataFrame(rest, "column_name string, schema_change string")
    return out.unionByName(extra.withColumn("volume_anomaly", F.lit(False)), allowMissingColumns=True)


def custom_metric(log: DataFrame, name: str, expression: str, ts: str, slices: Sequence[str] = (),
                  width: str = "1 day") -> DataFrame:
    """A user's SQL aggregate per window, overall and per slice."""
    labels = F.array(*[F.struct(k.alias("slice_key"), v.alias("slice_value")) for k, v in slice_labels(slices)])
    sliced = log.withColumns({"window_start": F.window(F.col(ts), width)["start"], "_s": labels}).withColumn(
        "_s", F.explode("_s"))
    return sliced.groupBy("window_start", F.col("_s.slice_key").alias("slice_key"),
                          F.col("_s.slice_value").alias("slice_value")).agg(
        F.expr(expression).cast("double").alias("value")).withColumn("metric", F.lit(name))


def _gate_rows(drift: DataFrame, column: str, kinds: Sequence[str]) -> DataFrame:
    """The rows a gate looks at: one column, unsliced, of the named kinds."""
    rows = drift.filter((F.col("column_name") == column) & F.col("drift_type").isin(*kinds))
    if "slice_key" in drift.columns:
        rows = rows.filter(F.coalesce(F.col("slice_key"), F.lit(ALL)) == ALL)
    return rows


def gate_candidates(drift: DataFrame, column: str = "prediction", kinds: Sequence[str] = DRIFT_KINDS) -> DataFrame:
    """For each kind of drift the row that a gate may need: the largest distance of its newest window. A gate says the same
    of these rows as of all, and of the candidates of two tables as of both tables together."""
    best = F.max_by(F.struct(*drift.columns), F.struct(F.col("window.start"), F.col("js_distance")))
    return _gate_rows(drift, column, kinds).groupBy("drift_type").agg(best.alias("_row")).select("_row.*")


def drift_gate(drift: DataFrame, threshold: float, force: bool = False, column: str = "prediction",
               kinds: Sequence[str] = DRIFT_KINDS) -> DataFrame:
    """One row: retrain or not, and why.

    Uses the newest window of the first kind of drift that has rows for the
    column, unsliced rows only. A null distance never trips, ``force`` always
    does. Equal newest windows (several versions) are judged by their largest
    distance.
    """
    at = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("drift_type"))
    rows = _gate_rows(drift, column, kinds)
    best = F.max(F.struct((-at).alias("rank"), F.col("window.start").alias("start"),
                          F.col("js_distance").alias("js"), F.col("drift_type").alias("kind")))
    js, kind = F.col("_b.js"), F.col("_b.kind")
    trip = F.coalesce(js >= F.lit(threshold), F.lit(False))
    measured = F.concat(F.lit(f"{column}: "), kind, F.lit(" distance "),
                        F.coalesce(F.format_string("%.4f", js), F.lit("unknown")),
                        F.when(trip, " reaches ").otherwise(" stays below "), F.lit(f"{threshold}"))
    found = F.when(F.col("_b").isNull(), F.lit(f"no drift rows for {column} yet")).otherwise(measured)
    return rows.agg(best.alias("_b")).select(
        (F.lit(True) if force else trip).alias("retrain_needed"), kind.alias("drift_type"),
        F.col("_b.start").alias("window_start"), js.alias("js_distance"),
        (F.lit("forced: drift gate bypassed") if force else found).alias("reason"))


def retrain_decision(gate: DataFrame, approval: DataFrame, model: str) -> DataFrame:
    """One row per candidate version: what to do, from the drift gate and the approval gate.

    ``keep`` without drift, else ``promote`` an approved version and ``reject``
    the others.
    """
    g = gate.select(F.lit(model).alias("model"), "retrain_needed", F.col("reason").alias("gate_reason"))
    a = approval.select(F.lit(model).alias("model"), "version", "approved", F.col("reason").alias("approval_reason"))
    action = (F.when(~F.col("retrain_needed"), "keep").when(F.col("approved"), "promote")
              .when(F.col("version").isNull(), "train").otherwise("reject"))
    return g.join(a, "model", "left").select("model", "version", "retrain_needed", "approved", action.alias("action"),
                                             "gate_reason", "approval_reason")


def window_change(stats: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Each window's numbers with those of the window before it and the difference.

    ``stats`` is an aggregated table: one row per window and key.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = {f"prev_{c}": F.lag(c).over(w) for c in columns}
    return stats.withColumns(before).withColumns({f"{c}_change": F.col(c) - F.col(f"prev_{c}") for c in columns})
