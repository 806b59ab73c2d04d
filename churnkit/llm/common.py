"""Helpers of the training-data operators: tables, the shared folder, stored intermediates, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch: texts can be long, so batches stay short.
BATCH_ROWS = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Short Arrow batches bound the memory of Python tasks on long texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="churnkit-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has used."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: later steps neither recompute it nor depend on
    the executors that made it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by a URI or a plain path; usable in tasks."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{uri}")


def write_then_rename(fs: pafs.FileSystem, path: str, raw: bytes) -> None:
    """Write a file under a temporary name of its own, then give it its name: readers see all of it or nothing, and
    attempts of a task that run at once end in the same file."""
    folder, _, name = path.rpartition("/")
    temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(raw)
    fs.move(temporary, path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterable[dict]], schema: str) -> DataFrame:
    """Run ``fn`` in every task over its batches, each a dict of column lists; it yields dicts of columns.

    Rows of one partition arrive in order and are never gathered.
    """
    arrow = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(arrow)
        inputs = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches if b.num_rows)
        for out in fn(inputs):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def text_of(name: str = "text"):
    """A text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(df: DataFrame, text: str, verdict: Callable[[list], list[bool]]) -> DataFrame:
    """The rows whose ``text`` passes, every column unchanged. ``verdict`` gets a batch of texts (nulls included)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(verdict(b.column(at).to_pylist()), pa.bool_()))

    at = df.columns.index(text)
    return df.mapInArrow(run, df.schema)
