"""Numbering the equal rows of a table without ids, each row where it is.

Rows are known by 128-bit hashes. A narrow pass counts the equal rows of every
task; running sums over the tasks of one hash give each task the number at which
its copies start. These starts, of hashes with several rows only, are written in
a folder per task. A task of a later pass reads its own folder and counts on from
there, so whole rows are never exchanged, and a row copied a billion times is a
few numbers per task.

A table that was exchanged before is checkpointed first, as its tasks might get
other rows in another pass. A task that meets other numbers of copies than were
counted stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from fairdraw.functions.columns import INTERNAL, name
from fairdraw.plans.lookup import hash_of
from fairdraw.sources.scratch import ensure_checkpoint_dir

COPY = INTERNAL + "copy"
_H1, _H2 = INTERNAL + "h1", INTERNAL + "h2"
_TASK = INTERNAL + "task"
OWN = {COPY, _H1, _H2, _TASK}


def _is_exchanged(rows: DataFrame) -> bool:
    return "Exchange" in rows._jdf.queryExecution().executedPlan().toString()


def _starts(marked: DataFrame) -> DataFrame:
    """``_TASK, _H1, _H2, n, start``: rows with the hashes in a task and copies in
    the tasks before it, of hashes with several rows."""
    counted = marked.select(_H1, _H2, _TASK).groupBy(_H1, _H2, _TASK).agg(F.count(F.lit(1)).alias("n"))
    # A hash has one row per task at most.
    same = Window.partitionBy(_H1, _H2)
    total = F.sum("n").over(same)
    before = F.sum("n").over(same.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    return counted.withColumns({"total": total, "start": before}).where("total > 1").drop("total")


def number_copies(rows: DataFrame) -> DataFrame:
    """The rows with a number, from 1, among the rows equal to them as ``COPY``."""
    spark = rows.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/copies-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if _is_exchanged(rows):
        rows = rows.checkpoint()
    columns = rows.columns
    marked = rows.withColumns({_H1: hash_of(columns, "first"), _H2: hash_of(columns, "second"), _TASK: F.spark_partition_id()})
    starts = _starts(marked)
    starts.repartition(_TASK).sortWithinPartitions(_TASK, _H1, _H2).write.partitionBy(_TASK).parquet(folder)
    h1, h2, task, copy = _H1, _H2, _TASK, COPY

    # Self-contained, so that executors need no more than numpy and pyarrow.
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyarrow import fs

        def keys(one, two):
            out = np.empty((len(one), 2), ">i8")
            out[:, 0], out[:, 1] = one, two
            return np.ascontiguousarray(out).view("V16").ravel()

        def known(number: int):
            if folder.startswith("file:"):
                where, at = fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
            else:
                where, at = fs.FileSystem.from_uri(folder)
            mine = f"{at}/{task}={number}"
            if where.get_file_info(mine).type == fs.FileType.NotFound:
                return None
            return ds.dataset(mine, filesystem=where, format="parquet").to_table()

        place: dict = {}
        taken = counts = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if taken is None:
                table = known(batch.column(task)[0].as_py())
                if table is not None:
                    found = keys(table.column(h1).to_numpy(), table.column(h2).to_numpy())
                    place = dict(zip(found.tolist(), range(len(found))))
                    taken, counts = table.column("start").to_numpy().copy(), table.column("n").to_numpy().copy()
                else:
                    taken = counts = np.empty(0, np.int64)
            number = np.ones(batch.num_rows, np.int64)
            if len(taken):
                at = np.array([place.get(k, -1) for k in keys(batch.column(h1).to_numpy(), batch.column(h2).to_numpy()).tolist()], np.int64)
                rows = np.flatnonzero(at >= 0)
                order = rows[np.argsort(at[rows], kind="stable")]
                which, first, n = np.unique(at[order], return_index=True, return_counts=True)
                number[order] = taken[at[order]] + np.arange(len(order)) - np.repeat(first, n) + 1
                taken[which] += n
                counts[which] -= n
            kept = [batch.column(i) for i in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(number)], [*batch.schema.names[:-3], copy])
        if counts is not None and counts.any():
            raise ValueError("a task got other rows than in the pass before; checkpoint the table first")

    # Functions over Arrow batches need plain names.
    plain = [F.col(name(c)).alias(f"{INTERNAL}c{i}") for i, c in enumerate(columns)]
    kind = StructType([*marked.select(*plain).schema.fields]).add(COPY, LongType(), False)
    return marked.select(*plain, _H1, _H2, _TASK).mapInArrow(run, kind).toDF(*columns, COPY)
