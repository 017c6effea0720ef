"""Sampling a stream micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from fairdraw.functions.priority import hex_position, priority
from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw


def sample_stream(
    stream: DataFrame,
    strata: Sequence[str],
    pct: float,
    min_rows: int = 1,
    *,
    ids: Sequence[str] | None,
    path: str,
    checkpoint: str,
    seed: int = 42,
    available_now: bool = True,
) -> StreamingQuery:
    """Draw a floor sample of every micro-batch and write it below ``path``.

    Each micro-batch is a chunk: shares and floor refer to its own rows. It is
    written to a folder of its own, which a replay after a failure overwrites
    with the same rows, since priorities depend on the rows alone.
    """
    quota = Quota(pct=pct, min_rows=min_rows)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times; keep it rather than its source.
        batch.persist()
        try:
            drawn = draw(batch, strata, quota, ids=ids, seed=seed)
            drawn.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_stream_sample(spark: SparkSession, path: str, schema_of: DataFrame) -> DataFrame:
    """All batches written so far, with their ``batch_id``."""
    schema = StructType([*schema_of.schema.fields]).add("batch_id", IntegerType())
    return spark.read.schema(schema).parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def sample_whole_stream(
    stream: DataFrame,
    strata: Sequence[str],
    pct: float,
    min_rows: int = 1,
    *,
    ids: Sequence[str],
    path: str,
    checkpoint: str,
    seed: int = 42,
    available_now: bool = True,
) -> StreamingQuery:
    """Draw a sample of the stream as a whole, with a floor for every stratum of it.

    A row is drawn if its priority lies below ``pct``, which needs no memory. For
    the floor the stream keeps the ``min_rows`` rows with the smallest priorities
    of each stratum: a state that is merged with each micro-batch. The state after
    a batch is a table of its own, made from that after the batch before, so a
    replay makes the same one; older states are removed. Both parts depend on the
    rows alone, so any cut of the stream into batches gives the same sample.
    """
    if not 0 < pct < 1 or min_rows < 1:
        raise ValueError("pct must lie between 0 and 1, and min_rows be at least 1")
    quota, limit = Quota(n=min_rows), F.expr(hex_position(f"{float(pct)!r}D"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(priority(seed, ids) < limit).write.mode("overwrite").parquet(f"{path}/drawn/batch_id={batch_id}")
            state = batch
            if batch_id:
                state = batch.unionByName(batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/state-{batch_id - 1}"))
            draw(state, strata, quota, ids=ids, seed=seed).write.mode("overwrite").parquet(f"{path}/state-{batch_id}")
            _remove(batch.sparkSession, f"{path}/state-{batch_id - 2}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_whole_stream_sample(
    spark: SparkSession, path: str, schema_of: DataFrame, pct: float, *, ids: Sequence[str], seed: int = 42
) -> DataFrame:
    """The sample after the last batch: the rows drawn by their priorities, and
    those of the floor that are not among them."""
    states = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state-*")
    found = states.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(states) or []
    numbers = [int(f.getPath().getName().rsplit("-", 1)[1]) for f in found]
    if not numbers:
        return spark.createDataFrame([], schema_of.schema)
    drawn = spark.read.schema(schema_of.schema).parquet(f"{path}/drawn")
    floor = spark.read.schema(schema_of.schema).parquet(f"{path}/state-{max(numbers)}")
    beyond = floor.where(priority(seed, ids) >= F.expr(hex_position(f"{float(pct)!r}D")))
    return drawn.select(*schema_of.columns).unionByName(beyond)
