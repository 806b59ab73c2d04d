"""Keyed tables in buckets: versions that are compared by a tree of digests, and a replica that takes changes without being rewritten.

Rows go to a bucket by a hash of their key. A version carries digests of its buckets and of groups of buckets, so a feed between two
versions reads only buckets that differ. A replica keeps a base and deltas for each bucket; a change writes to the buckets of its
keys, a read merges only buckets that have deltas, and a bucket with many deltas is rewritten alone. What is valid is said by a
manifest, which is written last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.sources.sync import change_feed, upsert
from churnkit.sources.tables import is_complete

# Buckets of a table: what one compares, merges or compacts at a time. Lists of them pass through the driver.
BUCKETS = 256
# Buckets, or groups of them, under one node of the tree.
FAN_OUT = 16


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; nulls are part of it."""
    nulls = F.concat(F.lit(""), *[F.when(F.col(k).isNull(), "1").otherwise("0") for k in keys])
    return F.pmod(F.xxhash64(*keys, nulls), F.lit(buckets)).cast("int")


def _digest(columns: Sequence[str]) -> list[Column]:
    """Order-free digests of some rows: their number and the sums of four 32-bit parts of two hashes."""
    values = [F.col(c) for c in columns]
    nulls = F.concat(F.lit(""), *[F.when(v.isNull(), "1").otherwise("0") for v in values])
    hashes = [F.xxhash64(*values, nulls), F.xxhash64(F.lit(7), nulls, *values)]
    parts = [p for h in hashes for p in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    return [F.count("*").alias("n"), *[F.sum(p).alias(f"d{i}") for i, p in enumerate(parts)]]


def save_version(df: DataFrame, keys: Sequence[str], path: str, buckets: int = BUCKETS) -> None:
    """Write a version of a keyed table: rows by bucket, and the digests of buckets and of their groups up to the root."""
    stored = df.withColumn("_bucket", bucket_of(keys, buckets))
    stored.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = _read(spark, f"{path}/rows", df.schema)
    level = rows.groupBy(F.col("_bucket").alias("node")).agg(*_digest(df.columns)).withColumn("level", F.lit(0))
    tree, width, at = level, buckets, 0
    while width > 1:
        width, at = -(-width // FAN_OUT), at + 1
        level = level.groupBy(F.floor(F.col("node") / FAN_OUT).cast("int").alias("node")).agg(
            F.sum("n").alias("n"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(4)]).withColumn("level", F.lit(at))
        tree = tree.unionByName(level)
    tree.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(path)


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ between two versions, found from the root down: of each level only nodes under a differing one."""
    a, b = spark.read.parquet(f"{old}/digests"), spark.read.parquet(f"{new}/digests")
    top = b.unionByName(a).agg(F.max("level").alias("level")).first()["level"]
    suspects = None
    for level in range(top if top is not None else -1, -1, -1):
        def nodes(t, level=level, suspects=suspects):
            own = t.filter(F.col("level") == level)
            return own if suspects is None else own.filter(F.floor(F.col("node") / FAN_OUT).isin(suspects))

        digest = lambda t: nodes(t).select("node", F.struct("n", *[f"d{i}" for i in range(4)]).alias("d"))  # noqa: E731, B023
        both = digest(a).alias("a").join(digest(b).alias("b"), "node", "full_outer")
        suspects = [r["node"] for r in both.filter(~F.col("a.d").eqNullSafe(F.col("b.d"))).select("node").collect()]
    return sorted(suspects or [])


def version_feed(spark: SparkSession, old: str, new: str, schema: T.StructType, keys: Sequence[str], preimages: bool = False) -> DataFrame:
    """The change feed between two saved versions of ``schema``; buckets with equal digests are not read."""
    changed = differing_buckets(spark, old, new)
    own = [_read(spark, f"{p}/rows", schema).filter(F.col("_bucket").isin(changed)).drop("_bucket") for p in (old, new)]
    return change_feed(*own, keys, preimages)


def _manifests(spark: SparkSession, root: str) -> list[int]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{root}/manifest")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n) for n in names if n.isdigit() and is_complete(spark, f"{root}/manifest/{n}"))


class Replica:
    """A keyed table that takes batches of changes. ``schema`` is that of its rows; changes have ``_change_type`` as well."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS, compact_at: int = 4):
        self.spark, self.root, self.schema, self.keys, self.buckets, self.compact_at = spark, root, schema, list(keys), buckets, compact_at

    def _manifest(self, number: int | None = None) -> dict[int, tuple[int, list[int]]]:
        """Bucket to (version of its base, its deltas, oldest first), as the newest manifest (or one that is named) has it."""
        found = _manifests(self.spark, self.root)
        number = found[-1] if number is None and found else number
        if number is None:
            return {}
        return {r["bucket"]: (r["base"], list(r["deltas"])) for r in self.spark.read.parquet(f"{self.root}/manifest/{number}").collect()}

    def _commit(self, number: int, state: dict[int, tuple[int, list[int]]]) -> None:
        rows = [(b, base, deltas) for b, (base, deltas) in sorted(state.items())]
        self.spark.createDataFrame(rows, "bucket int, base int, deltas array<int>").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/{number}")

    def _write(self, df: DataFrame, folder: str) -> list[int]:
        """Write rows by bucket; returns the buckets that have some."""
        df.withColumn("_bucket", bucket_of(self.keys, self.buckets)).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(folder)
        return [r["_bucket"] for r in _read(self.spark, folder, df.schema).select("_bucket").distinct().collect()]

    def create(self, base: DataFrame) -> None:
        self._commit(0, {b: (0, []) for b in self._write(base.select(*self.schema.names), f"{self.root}/base/0")})

    def apply(self, changes: DataFrame, number: int) -> None:
        """Add batch ``number`` (from 1, ascending; one row per key). Files are written for the buckets of its keys, and for buckets that have
        ``compact_at`` deltas then. A batch that is run again, after the same earlier ones, ends in the same state."""
        earlier = [n for n in _manifests(self.spark, self.root) if n < number]
        state = self._manifest(earlier[-1]) if earlier else {}
        delta = changes.select(*self.schema.names, "_change_type")
        for b in self._write(delta, f"{self.root}/delta/{number}"):
            base, deltas = state.get(b, (-1, []))
            state[b] = base, [*deltas, number]
        full = [b for b, (_, deltas) in state.items() if len(deltas) >= self.compact_at]
        if full:
            kept = self._write(self._rows({b: state[b] for b in full}), f"{self.root}/base/{number}")
            # a bucket whose rows are all gone has no base
            state.update({b: (number if b in kept else -1, []) for b in full})
        self._commit(number, state)

    def _parts(self, folder: str, schema: T.StructType, wanted: dict[int, list[int]]) -> DataFrame | None:
        """Rows of buckets (values) of several numbered datasets (keys), with the number as ``_number``."""
        out = None
        for number, own in sorted(wanted.items()):
            if number >= 0 and own:
                part = _read(self.spark, f"{self.root}/{folder}/{number}", schema).filter(F.col("_bucket").isin(own)).withColumn("_number", F.lit(number))
                out = part if out is None else out.unionByName(part)
        return out

    def _rows(self, state: dict[int, tuple[int, list[int]]]) -> DataFrame:
        bases: dict[int, list[int]] = {}
        merged: dict[int, list[int]] = {}
        deltas: dict[int, list[int]] = {}
        for b, (base, own) in state.items():
            (merged if own else bases).setdefault(base, []).append(b)
            for n in own:
                deltas.setdefault(n, []).append(b)
        names = self.schema.names
        empty = self.spark.createDataFrame([], self.schema)
        still = self._parts("base", self.schema, bases)
        out = still.select(*names) if still is not None else empty
        log = self._parts("delta", T.StructType([*self.schema.fields, T.StructField("_change_type", T.StringType())]), deltas)
        if log is None:
            return out
        row = F.struct(*names, "_change_type")
        by = [F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]
        last = log.groupBy(*by).agg(F.max_by(row, "_number").alias("_last")).select("_last.*")
        under = self._parts("base", self.schema, merged)
        return out.unionByName(upsert(under.select(*names) if under is not None else empty, last, self.keys).select(*names))

    def read(self) -> DataFrame:
        """The table as its newest manifest has it. Buckets without deltas are read as they are; the others are merged on their keys."""
        return self._rows(self._manifest())
