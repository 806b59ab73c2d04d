"""Change feed between two versions of a keyed table, and upserts from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], preimages: bool = False) -> DataFrame:
    """Rows that differ between two versions, tagged in ``_change_type``.

    ``insert`` and ``update`` rows carry the new values, ``delete`` rows the
    old ones; ``preimages`` adds the old row of each update. One shuffle per
    side on the key; nulls compare as equal, in keys too. A key has one row at
    most in each version.
    """
    columns = new.columns
    values = [c for c in columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                   F.struct(*[F.col(c) for c in columns]).alias("_old"))
    n = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys],
                   F.struct(*[F.col(c) for c in columns]).alias("_new"))
    on = [F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in keys]
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    joined = o.join(n, on, "full_outer").withColumn(
        "_kind",
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
        .when(~same, "update"),
    ).filter(F.col("_kind").isNotNull())

    def tagged(kind, row):
        return F.struct(F.lit(kind).alias("_change_type"), row.alias("_row"))

    images = [F.when(F.col("_kind") == "delete", tagged("delete", F.col("_old")))
              .when(F.col("_kind") == "insert", tagged("insert", F.col("_new")))
              .otherwise(tagged("update", F.col("_new")))]
    if preimages:
        images.append(F.when(F.col("_kind") == "update", tagged("update_preimage", F.col("_old"))))
    return (joined.select(F.explode(F.array(*images)).alias("_image"))
            .filter(F.col("_image").isNotNull())
            .select("_image._row.*", F.col("_image._change_type").alias("_change_type")))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New version of a keyed replica with the changes applied.

    ``changes`` holds at most one row per key; null keys are keys. One full
    outer join, from which each row is chosen. Without a ``_change_type``
    column every change is an upsert. The result is a plan over both inputs:
    write it to a new path, never over ``target``'s own.
    """
    columns = target.columns
    flagged = "_change_type" in changes.columns
    incoming = changes if flagged else changes.withColumn("_change_type", F.lit("update"))
    incoming = incoming.filter(F.col("_change_type").isin("insert", "update", "delete"))
    fresh = [c for c in incoming.columns if c not in columns and c != "_change_type"]
    old = target.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    new = incoming.select(F.struct(*[c for c in incoming.columns if c != "_change_type"]).alias("_new"), "_change_type",
                          *[F.col(k).alias(f"_n_{k}") for k in keys])
    both = old.join(new, [F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in keys], "full_outer")
    changed = F.col("_new").isNotNull()

    def chosen(c: str) -> Column:
        before = F.col(f"_old.{c}") if c in columns else F.lit(None)
        after = F.col(f"_new.{c}") if c in incoming.columns else F.lit(None)
        return F.when(changed, after).otherwise(before).alias(c)

    return (both.filter(F.coalesce(F.col("_change_type") != "delete", F.lit(True)))
            .select(*[chosen(c) for c in [*columns, *fresh]]))
