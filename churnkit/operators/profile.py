"""Profiling: counts, rates, summaries, correlation, outliers, bins, samples.

Column-by-column questions are answered by one wide aggregation that is then
turned into rows, so a table is read once however many columns it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions.columns import hash_uniform
from churnkit.operators.moments import correlations
from churnkit.operators.order import quantile_columns


def _to_rows(wide: DataFrame, cells: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Turn struct cells of a (small) wide result into rows."""
    return wide.select(*keep, F.explode(F.array(*cells)).alias("_x")).select(*keep, "_x.*")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def rate_by(df: DataFrame, group: str, target: str, means: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Rows, target rate and optional means per group, highest rate first."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.round(F.avg(target), digits).alias("rate"),
        *[F.round(F.avg(m), 2).alias(f"avg_{m}") for m in means],
    ).orderBy(F.desc("rate"), group)


def five_num(df: DataFrame, group: str, column: str, approx: bool = False) -> DataFrame:
    """Minimum, quartiles and maximum of a column per group."""
    q = quantile_columns(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group], approx=approx)
    ends = df.groupBy(group).agg(F.min(column).alias("min"), F.max(column).alias("max"), F.count(column).alias("n"))
    return ends.join(q.drop("column"), group, "left").select(group, "n", "min", "q1", "median", "q3", "max")


def describe(df: DataFrame, approx: bool = True) -> DataFrame:
    """One row per column: count, mean, deviation, ends and quartiles.

    Quartiles are approximate by default, as is usual for a summary table.
    Text, boolean, date and time columns get their first and last value in sort
    order, as text. A column of any other type is an error, not left out.
    """
    numeric = numeric_columns(df)
    shown = df.columns
    ordered = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.VarcharType, T.CharType)
    others = [f.name for f in df.schema.fields if f.name not in numeric and not isinstance(f.dataType, ordered)]
    if others:
        raise ValueError(f"columns without an order to describe: {', '.join(others)}")
    aggs, cells = [], []
    for i, c in enumerate(shown):
        is_num = c in numeric
        v = F.col(c).cast("double") if is_num else F.col(c)
        none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        aggs += [F.count(c).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if is_num:
            aggs += [F.avg(v).alias(f"m{i}"), F.stddev(v).alias(f"s{i}")]
            if approx:
                aggs.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"q{i}"))
        quart = [F.col(f"q{i}")[j] if is_num and approx else none_d for j in range(3)]
        cells.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
            (F.col(f"m{i}") if is_num else none_d).alias("mean"),
            (F.col(f"s{i}") if is_num else none_d).alias("stddev"),
            (F.col(f"lo{i}") if is_num else none_d).alias("min"),
            quart[0].alias("p25"), quart[1].alias("p50"), quart[2].alias("p75"),
            (F.col(f"hi{i}") if is_num else none_d).alias("max"),
            (none_s if is_num else F.col(f"lo{i}").cast("string")).alias("first_text"),
            (none_s if is_num else F.col(f"hi{i}").cast("string")).alias("last_text"),
        ))
    out = _to_rows(df.agg(*aggs), cells)
    if not approx and numeric:
        q = quantile_columns(df, numeric, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
        out = out.drop("p25", "p50", "p75").join(q, "column", "left")
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _to_rows(wide, [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])


def row_digest(df: DataFrame) -> Column:
    """128 bits of a row's values: two hashes of 64 bits, with a mark for each null."""
    values = [F.col(c) for c in df.columns]
    nulls = F.concat(F.lit(""), *[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.struct(F.xxhash64(*values, nulls).alias("a"), F.xxhash64(F.lit(7), nulls, *values).alias("b"))


def duplicate_count(df: DataFrame, digest: Column | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies.

    Rows are counted by their digests, 16 bytes each, merged map-side. Rows of a digest that occurs once are distinct; only those whose
    digest repeats are compared themselves. ``digest`` replaces the digest of a row.
    """
    key = row_digest(df) if digest is None else digest
    counts = df.select(key.alias("_d")).groupBy("_d").agg(F.count("*").alias("_n"))
    again = counts.filter("_n > 1").select("_d")
    own = df.withColumn("_d", key).join(again, "_d", "left_semi").groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    one = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count_if(F.col("_n") == 1).alias("_once"))
    more = own.agg(F.count("*").alias("_more"))
    distinct = F.col("_once") + F.col("_more")
    return one.join(more).select("total_rows", distinct.alias("distinct_rows"), (F.col("total_rows") - distinct).alias("duplicate_rows"))


def shape(df: DataFrame) -> DataFrame:
    """Rows of the table and, per data type, how many columns have it."""
    types: dict[str, int] = {}
    for _, t in df.dtypes:
        types[t] = types.get(t, 0) + 1
    cells = [F.struct(F.lit(t).alias("data_type"), F.lit(n).cast("long").alias("n_columns"))
             for t, n in sorted(types.items())]
    return _to_rows(df.agg(F.count("*").alias("n_rows")), cells, ["n_rows"])


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over one row per class
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 2))


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over rows with both values; null when one side is constant.

    The built-in ``corr`` raises a division error on a constant column in ANSI mode.
    """
    x, y = F.col(a), F.col(b)
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, both triangles.

    A constant column has no correlation: null. One scan, whatever the number of columns.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    name = F.array(*[F.lit(c) for c in columns])
    return correlations(df, columns).select(F.get(name, F.col("i")).alias("col_a"), F.get(name, F.col("j")).alias("col_b"), "corr")


def _direction(c: Column) -> Column:
    return F.when(c > 0, "positive").otherwise("negative")


def target_corr(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*columns, target])])
    wide = doubles.agg(*[_corr(c, target).alias(c) for c in columns])
    rows = _to_rows(wide, [F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in columns])
    return (rows.withColumns({"strength": F.abs("corr"), "direction": _direction(F.col("corr"))})
            .orderBy(F.desc_nulls_last("strength"), "feature"))


def top_pairs(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most correlated column pairs."""
    at = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    upper = corr_matrix(df, columns).filter(at[F.col("col_a")] < at[F.col("col_b")])
    return (upper.withColumns({"direction": _direction(F.col("corr"))})
            .orderBy(F.desc_nulls_last(F.abs("corr")), "col_a", "col_b").limit(k))


def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, fences and number of rows outside them, per column.

    The fences are a few scalars: they go through the driver so that the count
    is one narrow pass with a map-side partial sum.
    """
    q = {r["column"]: r for r in quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75}, approx=approx).collect()}
    known = [c for c in columns if c in q]
    cells, aggs = [], [F.count("*").alias("_rows")]
    for i, c in enumerate(known):
        q1, q3 = q[c]["q1"], q[c]["q3"]
        lower, upper = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        aggs.append(F.count_if((F.col(c) < lower) | (F.col(c) > upper)).alias(f"o{i}"))
        cells.append(F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(q3 - q1).alias("iqr"),
            F.lit(lower).alias("lower"), F.lit(upper).alias("upper"), F.col(f"o{i}").alias("outliers"),
            F.try_divide(F.col(f"o{i}") * 100.0, F.col("_rows")).alias("outlier_pct")))
    return _to_rows(df.agg(*aggs), cells).orderBy(F.desc("outliers"), "column")


def bin_edges(df: DataFrame, column: str, bins: int = 5, approx: bool = False) -> list[float]:
    """Quantile edges with repeats dropped; equal-width edges when one value remains."""
    names = {f"e{i}": i / bins for i in range(bins + 1)}
    row = quantile_columns(df, [column], names, approx=approx).first()
    if row is None:
        return []
    edges = sorted({row[n] for n in names if row[n] is not None})
    if len(edges) > 1:
        return edges
    pad = 0.001 * abs(edges[0]) or 0.001
    lo, hi = edges[0] - pad, edges[0] + pad
    return [lo + (hi - lo) * i / bins for i in range(bins + 1)]


def bin_index(column: Column | str, edges: Sequence[float]) -> Column:
    """Right-closed bin number from 0, the lowest edge included; null outside."""
    c = F.col(column) if isinstance(column, str) else column
    expr = F.when(c.isNull() | (c < edges[0]), F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        expr = expr.when(c <= upper, F.lit(i))
    return expr


def rate_by_bin(df: DataFrame, column: str, target: str, bins: int = 5, approx: bool = False) -> DataFrame:
    """Target rate per quantile bin of a column."""
    edges = bin_edges(df, column, bins, approx)
    if not edges:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("lower"), F.lit(0.0).alias("upper"),
                         F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("rate")).limit(0)
    at = F.array(*[F.lit(e) for e in edges])
    return (df.withColumn("bin", bin_index(column, edges)).filter(F.col("bin").isNotNull())
            .groupBy("bin").agg(F.count("*").alias("n"), F.avg(target).alias("rate"))
            .select("bin", F.get(at, F.col("bin")).alias("lower"), F.get(at, F.col("bin") + 1).alias("upper"),
                    "n", "rate"))


def box_stats(df: DataFrame, columns: Sequence[str], by: str, k: float = 1.5, approx: bool = False) -> DataFrame:
    """Box-plot numbers per class and column: quartiles, whiskers, outliers."""
    names = list(columns)
    q = quantile_columns(df, names, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], approx=approx)
    fences = q.groupBy(by).agg(*[
        F.max(F.when(F.col("column") == c, F.struct("q1", "median", "q3"))).alias(f"_q{i}") for i, c in enumerate(names)])
    rows = df.select(by, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(names)]).join(fences, by)
    aggs = []
    for i in range(len(names)):
        v, at = F.col(f"_v{i}"), F.col(f"_q{i}")
        spread = at["q3"] - at["q1"]
        inside = (v >= at["q1"] - k * spread) & (v <= at["q3"] + k * spread)
        aggs += [F.first(f"_q{i}").alias(f"_q{i}"), F.count(v).alias(f"_n{i}"), F.min(F.when(inside, v)).alias(f"_lo{i}"),
                 F.max(F.when(inside, v)).alias(f"_hi{i}"), F.count_if(~inside).alias(f"_out{i}")]
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_q{i}.q1"), F.col(f"_q{i}.median"), F.col(f"_q{i}.q3"), F.col(f"_n{i}").alias("n"),
                      F.col(f"_lo{i}").alias("whisker_low"), F.col(f"_hi{i}").alias("whisker_high"), F.col(f"_out{i}").alias("outliers"))
             for i, c in enumerate(names)]
    return _to_rows(rows.groupBy(by).agg(*aggs), cells, [by]).filter(F.col("n") > 0)


def compare_means(a: DataFrame, b: DataFrame, columns: Sequence[str],
                  names: tuple[str, str] = ("original", "drifted")) -> DataFrame:
    """Mean of each column in two cohorts, side by side."""
    def side(df, tag):
        return df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.lit(tag).alias("_cohort"))

    both = side(a, names[0]).unionByName(side(b, names[1]))
    wide = both.agg(*[F.avg(F.when(F.col("_cohort") == n, F.col(c))).alias(f"{c}__{n}")
                      for c in columns for n in names])
    return _to_rows(wide, [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(f"mean_{n}") for n in names])
                           for c in columns])


def round_summary(df: DataFrame, round_col: str = "round", batch_keys: Sequence[str] = ("cohort", "batch"),
                  prediction: str = "prediction", ok: str = "ok") -> DataFrame:
    """Predictions, positives, rate, batches and failed batches per round and overall.

    The input has one row per record sent. Records are first summed per batch,
    so the totals row is computed from batches and not from all records again.
    """
    served = F.col(ok) & F.col(prediction).isNotNull()
    per_batch = df.groupBy(round_col, *batch_keys).agg(
        F.count_if(served).alias("_n"),
        F.count_if(served & (F.col(prediction) == 1)).alias("_pos"),
        F.max((~F.col(ok)).cast("int")).alias("_bad"))
    return per_batch.rollup(round_col).agg(
        F.when(F.grouping(round_col) == 1, "overall").otherwise("round").alias("scope"),
        F.sum("_n").alias("predictions"), F.sum("_pos").alias("positives"),
        F.coalesce(F.try_divide(F.sum("_pos").cast("double"), F.sum("_n")), F.lit(0.0)).alias("positive_rate"),
        F.count("*").alias("batches"), F.sum("_bad").alias("errors"))


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer), the same ones on every run, in the order of their draw."""
    return df.orderBy(hash_uniform(seed, *keys), *keys).limit(n)


def sliced_agg(df: DataFrame, slices: Sequence[str], aggs: Mapping[str, Column],
               by: Sequence[str] = ()) -> DataFrame:
    """The same aggregates overall and within each value of each slice column.

    Rows carry ``slice_key`` and ``slice_value``; both are null for the
    overall rows.
    """
    by, slices = list(by), list(slices)
    sets = [by, *[[*by, s] for s in slices]]
    out = df.groupingSets(sets, *by, *slices).agg(
        *[e.alias(k) for k, e in aggs.items()], *[F.grouping(s).alias(f"_g_{s}") for s in slices])
    key = value = None
    for s in slices:
        hit = F.col(f"_g_{s}") == 0
        key = F.when(hit, s) if key is None else key.when(hit, s)
        value = F.when(hit, F.col(s).cast("string")) if value is None else value.when(hit, F.col(s).cast("string"))
    none = F.lit(None).cast("string")
    return out.select(*by, (none if key is None else key).alias("slice_key"),
                      (none if value is None else value).alias("slice_value"), *aggs)
