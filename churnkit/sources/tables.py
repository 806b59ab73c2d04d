"""Sources and sinks: parquet and catalog tables, logs, CSV, declared rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet dataset ``name`` below ``folder`` (a directory or one file)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def save(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite a parquet dataset and return it read back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None,
               bucket_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Overwrite a catalog table; bucketed tables join on their key without a shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_log(df: DataFrame, path: str) -> None:
    """Append to a log. Files may carry new columns; see :func:`read_log`."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log with the union of all columns ever appended, absent ones null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the target's columns in its order and types; missing ones are null."""
    have = set(df.columns)

    def target(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in have else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select([target(f) for f in schema.fields])


def rows(spark: SparkSession, values: Iterable[tuple], ddl: str) -> DataFrame:
    """Small literal table with a declared schema."""
    return spark.createDataFrame(list(values), ddl)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished the dataset at ``path``: its marker of success is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marker = hadoop.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def ensure(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Reuse the finished dataset at ``path`` or build and store it; one that was left half-written is built again.

    What is wrong with a finished dataset is raised, not built over.
    """
    return spark.read.parquet(path) if is_complete(spark, path) else save(builder(), path)


def ensure_table(spark: SparkSession, name: str, builder: Callable[[], DataFrame],
                 path: str | None = None) -> DataFrame:
    """Reuse the catalog table ``name`` or build and store it."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return save_table(builder(), name, path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Types are inferred unless a schema is given.

    Inference reads the files twice; give the schema for large inputs.
    """
    reader = spark.read.option("header", "true")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)


def write_sample(df: DataFrame, n: int, path: str, order: Sequence[str]) -> None:
    """First ``n`` rows in the given order as one CSV file with a header."""
    df.orderBy(*order).limit(n).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def int_range(spark: SparkSession, n: int | Column, name: str = "id", **derived: Column) -> DataFrame:
    """``0 .. n-1`` with derived columns added by expression."""
    return spark.range(n).withColumnRenamed("id", name).withColumns(derived)
