"""Streams over an append-only log; each runs until its input is used up or stopped.

Checkpoints and outputs live under paths the caller gives, which must be on
storage shared by all executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnkit.operators.monitor import drift_gate, gate_candidates, slice_labels
from churnkit.operators.payload import unpack_payload
from churnkit.sources.sync import upsert
from churnkit.sources.tables import is_complete, save


def stream_parquet(spark: SparkSession, folder: str, schema: T.StructType, only: str | None = None,
                   files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, as they arrive; ``only`` is a file-name pattern."""
    reader = spark.readStream.schema(schema)
    if only:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def unpack_stream(raw: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """One row per prediction; the batch operator, which keeps no state."""
    return unpack_payload(raw, features, **options)


def deliveries_stream(log: DataFrame, ts: str, key: str = "request_id", late: str = "1 hour") -> DataFrame:
    """The first delivery of each request, as they arrive; retries that come while its key is kept are dropped.

    A key is kept until the watermark is ``late`` past its first delivery, so state holds the keys of that span and no
    more, and a retry up to ``late`` after it is always recognised. Keyed rows later than the watermark are dropped. Rows
    without a key cannot be told to be retries and stay, as in ``first_deliveries``.
    """
    once = log.filter(F.col(key).isNotNull()).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return once.unionByName(log.filter(F.col(key).isNull()))


def profile_stream(log: DataFrame, columns: Sequence[str], ts: str, version: str = "model_version",
                   slices: Sequence[str] = (), width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Per closed window, version and slice: rows, and nulls, mean, deviation, ends, distinct values and median of each column.

    State is one row per open window, version and slice; distinct values and medians are sketches. Rows later than ``late``
    are dropped and a window is emitted once the watermark passes its end.
    """
    aggs: list[Column] = [F.count("*").alias("rows")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"), F.avg(c).alias(f"{c}_mean"), F.stddev(c).alias(f"{c}_stddev"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.approx_count_distinct(c).alias(f"{c}_distinct"),
                 F.percentile_approx(c, 0.5, 10000).alias(f"{c}_median")]
    labels = F.array(*[F.struct(k.alias("slice_key"), v.alias("slice_value")) for k, v in slice_labels(slices)])
    sliced = log.withWatermark(ts, late).withColumn("_slice", F.explode(labels))
    parts = ("nulls", "mean", "stddev", "min", "max", "distinct", "median")
    return (sliced.groupBy(F.window(ts, width).alias("w"), version, "_slice.slice_key", "_slice.slice_value").agg(*aggs)
            .select(F.col("w.start").alias("window_start"), version, "slice_key", "slice_value",
                    *["rows", *[f"{c}_{s}" for c in columns for s in parts]]))


def latest_change(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change per key by the order columns, which should break ties."""
    rest = F.struct(*[F.col(c) for c in changes.columns])
    return (changes.groupBy(*keys).agg(F.max_by(rest, F.struct(*[F.col(c) for c in order])).alias("_last"))
            .select("_last.*"))


def sync_stream(changes: DataFrame, base: DataFrame, keys: Sequence[str], order: Sequence[str], root: str, checkpoint: str,
                every: int = 16, available_now: bool = True) -> StreamingQuery:
    """Keep a replica of a keyed table up to date from a stream of its changes.

    A micro-batch stores the last change of each of its keys in a folder of its own. After every ``every`` batches the
    newest version of the replica and the changes since are written as its next version, so a read meets one version and
    fewer than ``every`` batches of changes. A batch that is run again overwrites what it wrote.
    """
    spark, schema = changes.sparkSession, changes.schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        latest_change(batch, keys, order).write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
        if (batch_id + 1) % every == 0:
            now = _replica_at(spark, base, root, schema, keys, order, batch_id)
            now.write.mode("overwrite").parquet(f"{root}/versions/{batch_id}")

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    """Numbers of the finished datasets in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit()]
    return sorted(n for n in numbers if is_complete(spark, f"{folder}/{prefix}{n}"))


def _replica_at(spark: SparkSession, base: DataFrame, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
                last: int | None) -> DataFrame:
    versions = [n for n in _numbers(spark, f"{root}/versions") if last is None or n < last]
    newest = versions[-1] if versions else -1
    start = spark.read.schema(base.schema).parquet(f"{root}/versions/{newest}") if versions else base
    since = [n for n in _numbers(spark, f"{root}/changes", "batch=") if n > newest and (last is None or n <= last)]
    if not since:
        return start
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    synced = spark.read.schema(stored).option("basePath", f"{root}/changes").parquet(*[f"{root}/changes/batch={n}" for n in since])
    changed = latest_change(synced, keys, ["batch", *order])
    return upsert(start, changed.drop("batch", *[o for o in order if o not in base.columns]), keys).select(*base.columns)


def replica(base: DataFrame, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The replica as it is now: its newest stored version (``base`` before the first) with the changes since. ``schema`` is
    that of the changes."""
    return _replica_at(base.sparkSession, base, root, schema, keys, order, None)


def gate_stream(drift: DataFrame, state_path: str, decisions_path: str, threshold: float, checkpoint: str,
                options: Mapping | None = None) -> StreamingQuery:
    """Judge the gate again whenever drift rows arrive.

    What a gate may need of all rows so far is one row for each kind of drift. Each micro-batch joins its own such rows to
    those of the batch before, stores the result and one decision under its id, and reads nothing older.
    """
    spark, schema = drift.sparkSession, drift.schema
    settings = dict(options or {})
    looked_at = {k: v for k, v in settings.items() if k in ("column", "kinds")}

    def judge(batch: DataFrame, batch_id: int) -> None:
        seen = batch
        if batch_id:
            seen = batch.unionByName(spark.read.schema(schema).parquet(f"{state_path}/{batch_id - 1}"))
        state = save(gate_candidates(seen, **looked_at), f"{state_path}/{batch_id}")
        decision = drift_gate(state, threshold, **settings).withColumn("batch_id", F.lit(batch_id))
        decision.write.mode("overwrite").parquet(f"{decisions_path}/batch={batch_id}")

    return (drift.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
