"""Tables and files that operators write in the folder all executors share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from fairdraw.sources.scratch import ensure_checkpoint_dir

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A name for a new folder below the shared one, as a qualified URI."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Python tasks planned and run inside get so many rows at a time; long
    texts would otherwise make batches of any size."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def written(df: DataFrame, folder: str, name: str, rows: int = 512) -> DataFrame:
    """The table after writing it to the shared folder: what follows reads the
    files and survives lost executors. The folder is the caller's to remove."""
    spark = df.sparkSession
    with batches_of(spark, rows):
        df.write.parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """Where Python tasks open a file of the shared folder."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def published(folder: str, name: str):
    """A stream to a file that appears under its name only when complete. Each
    attempt of a task writes a file of its own; its name is what the task
    returns, so files of failed attempts are never read."""
    where, path = filesystem(folder)
    where.create_dir(path, recursive=True)
    draft = f"{path}/_{name}"
    with where.open_output_stream(draft, compression=None) as stream:
        yield stream
    where.move(draft, f"{path}/{name}")


def attempt_name(stem: str, suffix: str) -> str:
    return f"{stem}-{uuid.uuid4().hex[:12]}.{suffix}"
