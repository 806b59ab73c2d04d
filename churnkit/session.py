"""Session settings and the shared folder that eager steps may write to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job should carry on a cluster. Partition counts are left to the
# cluster's own configuration; adaptive execution coalesces and splits them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "churnkit", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/churnkit/{name}-{uuid.uuid4().hex}"


def kept_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh path of the shared folder and read again, for a result that several steps read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MIN_RANGES, ROWS_PER_RANGE = 16, 250_000


def range_count(df: DataFrame) -> int:
    """How many value ranges a distributed ordering of ``df`` is cut into: so many that a range's rows fit one task, however
    many rows there are. Counting them is a pass over the input that reads no column."""
    return max(MIN_RANGES, df.count() // ROWS_PER_RANGE)
