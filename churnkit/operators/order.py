"""Order statistics over whole tables without one big sorted task.

A window without a partition puts every row into one task. Here the ordered
domain is first cut into ranges; ranges get their totals from a partial
aggregation, a running total over the (few) ranges gives each one its offset,
and only rows inside one range are ever sorted together. The cut points affect
balance only, never the result.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions.columns import hash_uniform
from churnkit.session import kept_once, range_count


def value_ranges(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``_range_<column>``: which of about ``ranges`` equal-count ranges a value is in.

    One pass builds a mergeable sketch per column; the driver receives only
    ``ranges`` cut points per column. Nulls get range -1. Rough cut points do:
    they decide how even the ranges are, nothing else.
    """
    n = ranges or range_count(df)
    cuts = _cut_points(df, columns, n)
    return _assign_ranges(df, {c: sorted(set(cuts[c])) for c in columns})


def _cut_points(df: DataFrame, columns: Sequence[str], n: int) -> dict[str, list[float]]:
    """Up to ``n - 1`` finite values per column that split its rows evenly; a value in many rows repeats."""
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, max(1000, 2 * n)).alias(c) for c in columns]).first()
    return {c: [e for e in (row[c] or []) if math.isfinite(e)] for c in columns}


def _assign_ranges(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    cut = [c for c in edges if edges[c]]
    out = df.withColumns({f"_range_{c}": F.when(F.col(c).isNull(), -1).otherwise(0) for c in edges if not edges[c]})
    if not cut:
        return out
    out = Bucketizer(
        splitsArray=[[float("-inf"), *edges[c], float("inf")] for c in cut],
        inputCols=[f"_in_{c}" for c in cut], outputCols=[f"_out_{c}" for c in cut], handleInvalid="keep",
    ).transform(out.withColumns({f"_in_{c}": F.col(c).cast("double") for c in cut}))
    return (out.withColumns({f"_range_{c}": F.coalesce(F.col(f"_out_{c}").cast("int"), F.lit(-1)) for c in cut})
            .drop(*[f"_in_{c}" for c in cut], *[f"_out_{c}" for c in cut]))


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` between two aliased inputs."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


# Up to this many groups, cut points and counts of all groups go through the driver; more groups share cut points. Both
# ways find the same ranks and interpolate alike.
MAX_GROUPS = 2_000
SKETCH_ACCURACY = 2_000


def _same_group(values: Sequence) -> tuple:
    """A group as a key of a dict: NaN, which is unlike itself, by its name."""
    return tuple("NaN" if isinstance(v, float) and v != v else v for v in values)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    method: str = "linear", ranges: int | None = None, max_groups: int = MAX_GROUPS) -> DataFrame:
    """Exact quantiles as rows ``by..., column, prob, value``.

    ``linear`` interpolates between neighbours; ``discrete`` gives an element of
    the data. NaN counts as missing. Values are taken as doubles: integers
    beyond 2**53 and decimals are as exact as those.

    A first pass counts rows and sketches each group; the sketch gives a narrow
    bracket around each wanted rank. A second pass counts rows below each
    bracket edge, and a third shuffles only the values inside brackets. The
    sketch decides how narrow a bracket is, never the result. With more groups
    than ``max_groups`` the cut points are shared by all groups instead.
    """
    if method not in ("linear", "discrete"):
        raise ValueError(f"method must be 'linear' or 'discrete', not {method!r}")
    by, ps = list(by), [float(p) for p in probs]
    narrow = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    step = 2.0 / SKETCH_ACCURACY
    around = [min(1.0, max(0.0, p + s)) for p in ps for s in (-step, step)]
    heads = narrow.groupBy(*by).agg(
        *[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"_e_{c}") for c in columns],
    ).limit(max_groups + 1).collect()
    if len(heads) > max_groups:
        return _ranged_quantiles(narrow, columns, ps, by, method, ranges)
    return _bracketed_quantiles(narrow, columns, ps, by, method, heads, ranges)


def _wanted(p: float, n: int, method: str) -> tuple[float, list[int]]:
    """Position of a quantile among ``n`` ordered values and the ranks it needs, from 0."""
    if method == "linear":
        pos = p * (n - 1)
    else:
        pos = float(max(math.ceil(round(p * n, 9)) - 1, 0))
    return pos, sorted({math.floor(pos), math.ceil(pos)})


def _bracketed_quantiles(narrow: DataFrame, columns, ps, by, method, heads, ranges) -> DataFrame:
    spark = narrow.sparkSession
    groups = [tuple(r[g] for g in by) for r in heads]
    # from the lower cut to just above the upper one: a value that fills both is a bracket of its own
    edges = [{c: sorted({e if i % 2 == 0 else math.nextafter(e, math.inf) for i, e in enumerate(r[f"_e_{c}"] or [])})
              for c in columns} for r in heads]
    width = max([len(e[c]) for e in edges for c in columns], default=0)
    keys = narrow.select(*by).schema

    def with_group(values: list[tuple], ddl_types: list[tuple[str, str]]) -> DataFrame:
        """The rows with per-group values: literals without groups, else a bounded broadcast join."""
        if not by:
            return narrow.withColumns({name: _literal(values[0][i]).cast(kind)
                                       for i, (name, kind) in enumerate(ddl_types)})
        added = T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in ddl_types))
        schema = T.StructType([*keys.fields, *added.fields])
        side = F.broadcast(spark.createDataFrame([(*g, *v) for g, v in zip(groups, values)], schema))
        names = [n for n, _ in ddl_types]
        return narrow.alias("d").join(side.alias("s"), same_keys("d", "s", by)).select("d.*", *[F.col(f"s.{n}") for n in names])

    padded = [tuple(e[c] + [math.inf] * (width - len(e[c])) for c in columns) for e in edges]
    edged = with_group(padded, [(f"_a{i}", "array<double>") for i in range(len(columns))])
    counts = edged.groupBy(*by).agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)], *[
        F.expr(f"count_if(`{c}` < _a{i}[{j}]) AS _lt{i}_{j}") for i, c in enumerate(columns) for j in range(width)
    ]).collect()
    by_group = {_same_group(r[g] for g in by): r for r in counts}

    known: dict[tuple, float] = {}  # (group, column, rank) -> value
    open_ranks: dict[tuple, tuple[int, int]] = {}  # (group, column, rank) -> (bracket id, rank inside)
    brackets: dict[tuple, int] = {}  # (group number, column number, bracket) -> id
    found: list[tuple] = []
    for gi, g in enumerate(groups):
        r = by_group[_same_group(g)]
        for i, c in enumerate(columns):
            n, e = r[f"_n{i}"], edges[gi][c]
            below = [r[f"_lt{i}_{j}"] for j in range(len(e))]
            for p in ps if n else []:
                pos, ranks = _wanted(p, n, method)
                found.append((gi, i, p, pos, ranks))
                for k in ranks:
                    j = bisect_right(below, k)  # below[j-1] <= k < below[j]
                    if 0 < j < len(e) and e[j] == math.nextafter(e[j - 1], math.inf):
                        known[gi, i, k] = e[j - 1]
                        continue
                    if (gi, i, j) not in brackets:
                        brackets[gi, i, j] = len(brackets)
                    open_ranks[gi, i, k] = (brackets[gi, i, j], k - (below[j - 1] if j else 0))
    if brackets:
        per_group = [[[] for _ in columns] for _ in groups]
        for (gi, i, j), bid in brackets.items():
            e = edges[gi][columns[i]]
            lo, hi = e[j - 1] if j else -math.inf, e[j] if j < len(e) else math.inf
            per_group[gi][i].append((bid, lo, hi))
        kind = "array<struct<id:int,lo:double,hi:double>>"
        src = with_group([tuple(x) for x in per_group], [(f"_b{i}", kind) for i in range(len(columns))])
        # most rows are outside every bracket: drop them by plain comparisons first
        most = [max(len(g[i]) for g in per_group) for i in range(len(columns))]
        src = src.filter(" OR ".join(
            f"(`{c}` >= get(_b{i}, {k}).lo AND `{c}` <= get(_b{i}, {k}).hi)" for i, c in enumerate(columns)
            for k in range(most[i])))
        cells = F.flatten(F.array(*[
            F.transform(F.filter(F.col(f"_b{i}"), _bracket_test(c)), _bracket_cell(c)) for i, c in enumerate(columns)]))
        hits = src.select(F.explode(cells).alias("_x")).select("_x.*")
        picks = spark.createDataFrame(sorted(set(open_ranks.values())), "id int, rank long")
        # rows of each bracket, as counted
        sizes = []
        for (gi, i, j) in brackets:
            r, e = by_group[_same_group(groups[gi])], edges[gi][columns[i]]
            upto = r[f"_lt{i}_{j}"] if j < len(e) else r[f"_n{i}"]
            sizes.append(upto - (r[f"_lt{i}_{j - 1}"] if j else 0))
        got = _values_at(hits, picks, max(sizes), ranges)
        values = {(r["id"], r["rank"]): r["v"] for r in got.collect()}
        known.update({key: values[at] for key, at in open_ranks.items()})

    out = []
    for gi, i, p, pos, ranks in found:
        lo, hi = known[gi, i, ranks[0]], known[gi, i, ranks[-1]]
        between = pos - math.floor(pos)
        out.append((*groups[gi], columns[i], p, lo if lo == hi or not between else lo + (hi - lo) * between))
    schema = T.StructType([*keys.fields, T.StructField("column", T.StringType()), T.StructField("prob", T.DoubleType()),
                           T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(out, schema)


def _literal(value: list) -> Column:
    if value and isinstance(value[0], tuple):
        return F.array(*[F.struct(F.lit(b).alias("id"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for b, lo, hi in value])
    return F.array(*[F.lit(v) for v in value])


def _in_bracket(v: Column, lo: Column, hi: Column) -> Column:
    # the last bracket includes positive infinity
    return (v >= lo) & ((v < hi) | (hi == F.lit(math.inf)))


def _bracket_test(c: str):
    return lambda b: _in_bracket(F.col(c), b["lo"], b["hi"])


def _bracket_cell(c: str):
    return lambda b: F.struct(b["id"].alias("id"), F.col(c).alias("v"))


# Rows of a bracket that are put in order in one task; larger brackets are cut into ranges.
BRACKET_ROWS = 2_000_000


def _values_at(hits: DataFrame, picks: DataFrame, largest: int, ranges: int | None) -> DataFrame:
    """Value at each ``rank`` (from 0) of each ``id`` in rows ``id, v``, of which an id has ``largest`` at most."""
    counts = hits.groupBy("id", "v").agg(F.count("*").alias("m"))
    if largest <= BRACKET_ROWS and ranges is None:
        upto = F.sum("m").over(Window.partitionBy("id").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        local = counts.withColumn("upto", upto)
    else:
        ranged = value_ranges(kept_once(counts, "hits"), ["v"], ranges).withColumnRenamed("_range_v", "rng")
        inside = Window.partitionBy("id", "rng").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy("id").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
        sizes = ranged.groupBy("id", "rng").agg(F.sum("m").alias("n")).select(
            "id", "rng", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        local = ranged.join(sizes, ["id", "rng"]).withColumn("upto", F.sum("m").over(inside) + F.col("before"))
    # as many picks as wanted ranks: groups x columns x probabilities, with at most MAX_GROUPS groups
    found = local.join(F.broadcast(picks), "id").filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("m")))
    return found.select("id", "rank", "v")


def _ranged_quantiles(narrow: DataFrame, columns, probs, by, method, ranges) -> DataFrame:
    """Quantiles of very many groups: cut points shared by all groups, only needed ranges shuffled."""
    ranged = value_ranges(narrow, columns, ranges)
    long = ranged.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"), F.col(f"_range_{c}").alias("rng"))
        for c in columns])).alias("_x")).select(*by, "_x.*").filter(F.col("v").isNotNull())

    group = [*by, "column"]
    per_range = long.groupBy(*group, "rng").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*group).orderBy("rng").rowsBetween(Window.unboundedPreceding, 0)
    per_range = (per_range.withColumn("last", F.sum("n").over(upto))
                 .withColumn("total", F.sum("n").over(Window.partitionBy(*group))))

    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if method == "linear":
        pos = F.col("prob") * (F.col("total") - 1)
        ranks = F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))
    else:
        pos = F.greatest(F.ceil(F.round(F.col("prob") * F.col("total"), 9)) - 1, F.lit(0)).cast("double")
        ranks = F.array(F.floor("pos"))
    targets = (per_range.withColumn("prob", F.explode(wanted)).withColumn("pos", pos)
               .withColumn("rank", F.explode(ranks))
               .filter((F.col("rank") < F.col("last")) & (F.col("rank") >= F.col("last") - F.col("n")))
               .select(*group, "rng", "prob", "pos", "rank", (F.col("last") - F.col("n")).alias("before")))

    spots = targets.select(*group, "rng").distinct()
    where = [*group, "rng"]
    hits = (long.alias("l").join(spots.alias("s"), same_keys("l", "s", where), "left_semi")
            .groupBy(*where, "v").agg(F.count("*").alias("m")))
    inside = Window.partitionBy(*where).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("upto", F.sum("m").over(inside))
    found = hits.alias("h").join(targets.alias("t"), same_keys("h", "t", where) & (
        F.col("t.rank") < F.col("t.before") + F.col("h.upto")) & (
        F.col("t.rank") >= F.col("t.before") + F.col("h.upto") - F.col("h.m")))
    picked = found.select(*[F.col(f"t.{g}").alias(g) for g in group], "t.prob", "t.pos", "h.v")
    between = F.first("pos") - F.floor(F.first("pos"))
    value = F.when(F.min("v") == F.max("v"), F.min("v")).otherwise(F.min("v") + (F.max("v") - F.min("v")) * between)
    return picked.groupBy(*group, "prob").agg(value.alias("value"))


def quantiles(df: DataFrame, column: str, probs: Sequence[float], method: str = "discrete",
              approx: bool = False, accuracy: int = 10000) -> list[float | None]:
    """Cut points of one column on the driver; exact unless ``approx``."""
    if approx:
        return list(df.agg(F.percentile_approx(column, list(probs), accuracy)).first()[0] or [None] * len(probs))
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, [column], probs, method=method).collect()}
    return [got.get(float(p)) for p in probs]


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = (),
                     method: str = "linear", approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Quantiles side by side: one row per ``by..., column``, one column per name in ``probs``."""
    by = list(by)
    if approx:
        long = df.select(*by, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns
        ])).alias("_x")).select(*by, "_x.*")
        return long.groupBy(*by, "column").agg(
            *[F.percentile_approx("v", p, accuracy).alias(n) for n, p in probs.items()])
    rows = exact_quantiles(df, columns, sorted(set(probs.values())), by, method)
    return rows.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for n, p in probs.items()])


def draw_rank(df: DataFrame, draw: Column, tie: Sequence[str], by: Sequence[str] = (), out: str = "rank",
              ranges: int | None = None) -> DataFrame:
    """Row number from 1 in order of a uniform draw (``tie`` breaks equal draws), per ``by``.

    A uniform draw splits evenly into equal-width ranges, so no range is large
    and no sketch is needed.
    """
    n = ranges or range_count(df)
    drawn = df.withColumn("_draw", draw).withColumn("_rng", F.floor(F.col("_draw") * n))
    return _number_rows(drawn, ["_draw", *tie], by, out).drop("_draw", "_rng")


def value_rank(df: DataFrame, column: str, tie: Sequence[str], by: Sequence[str] = (), out: str = "rank",
               seed: int = 42, ranges: int | None = None) -> DataFrame:
    """Row number from 1 in order of a numeric column, per ``by``.

    Equal values follow in the order of a draw on the ``tie`` key, then the key
    itself. Nulls come first and NaN last, infinities next to them. A value that
    fills several ranges gets a range of its own, which the draw splits into as
    many parts; nulls, NaN and infinities are split alike. Integers that a
    double cannot tell apart share a range, which is then ordered as one.
    """
    n = ranges or range_count(df)
    cuts = _cut_points(df, [column], n)[column]
    exact = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType))
    hot = {e: k for e, k in Counter(cuts).items() if k > 1 and (exact or isinstance(df.schema[column].dataType, T.LongType)
                                                                and abs(e) < 2**53)}
    edges = sorted({*cuts, *(math.nextafter(e, math.inf) for e in hot)})
    ranged = _assign_ranges(df, {column: edges}).withColumn("_draw", hash_uniform(seed, *tie))
    rng, value = F.col(f"_range_{column}"), F.col(column).cast("double")
    # even places are ranges; odd ones between them are free for infinities
    last = len(edges)
    place = (F.when(value == math.inf, 2 * last + 1).when(value == -math.inf, -1).when(F.isnan(value), 2 * last + 2)
             .otherwise(2 * rng))
    # parts per range, by range number: range i + 1 starts at edge i
    parts = ",".join(["1", *[str(hot.get(e, 1)) for e in edges]])
    special = rng.isNull() | (rng < 0) | F.isnan(value) | (F.abs(value) == math.inf)
    split = F.when(special, F.lit(n)).otherwise(F.coalesce(F.get(F.split(F.lit(parts), ","), rng).cast("int"), F.lit(1)))
    part = F.floor(F.col("_draw") * split)
    ranged = ranged.withColumn("_rng", place.cast("long") * F.lit(1 << 32) + part).drop(f"_range_{column}")
    return _number_rows(ranged, [column, "_draw", *tie], by, out).drop("_rng", "_draw")


def _group_key(by: Sequence[str]) -> Column:
    """The group as one never-null struct: nulls inside compare as equal, so a plain
    join on it matches null groups and reuses the window's partitioning."""
    return F.struct(*[F.col(b) for b in by]) if by else F.lit(0)


def _number_rows(df: DataFrame, order: Sequence[str], by: Sequence[str], out: str) -> DataFrame:
    keyed = df.withColumn("_by", _group_key(by))
    sizes = keyed.groupBy("_by", "_rng").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_by").orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_by", "_rng", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_by", "_rng").orderBy(*order)
    numbered = keyed.withColumn("_pos", F.row_number().over(inside))
    return numbered.join(offsets, ["_by", "_rng"]).select(*df.columns, (F.col("_before") + F.col("_pos")).alias(out))


def running_counts(df: DataFrame, score: str, sums: dict[str, Column], by: Sequence[str] = (),
                   ranges: int | None = None) -> DataFrame:
    """One row per distinct score with each sum at that score and running from the top.

    Adds ``<name>`` and ``<name>_upto`` (scores above plus this one). Ties are
    collapsed before anything is ordered, so a hot score costs one row.
    """
    by, names = list(by), list(sums)
    # read for the cut points, the totals and the ranges: stored, so that the input is read once
    counts = kept_once(df.groupBy(*by, score).agg(*[e.alias(k) for k, e in sums.items()]), "scores")
    ranged = (value_ranges(counts, [score], ranges).withColumnRenamed(f"_range_{score}", "_rng")
              .withColumn("_by", _group_key(by)))
    totals = ranged.groupBy("_by", "_rng").agg(*[F.sum(k).alias(k) for k in names])
    above = Window.partitionBy("_by").orderBy(F.desc("_rng")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_by", "_rng", *[F.coalesce(F.sum(k).over(above), F.lit(0)).alias(f"_{k}_above") for k in names])
    inside = Window.partitionBy("_by", "_rng").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_{k}_in": F.sum(k).over(inside) for k in names})
    return local.join(offsets, ["_by", "_rng"]).select(
        *by, score, *names, *[(F.col(f"_{k}_above") + F.col(f"_{k}_in")).alias(f"{k}_upto") for k in names])
