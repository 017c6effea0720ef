"""Row numbers over a whole table, and the place of rows in their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL, text
from fairdraw.functions.columns import name as quoted
from fairdraw.plans.lookup import join_on_keys
from fairdraw.sources.scratch import ensure_checkpoint_dir

_PLACE = INTERNAL + "place"
_PART = INTERNAL + "part"
_BEFORE = INTERNAL + "before"
#: Ids of rows by their place: a file's path and the number of the row in it.
FILE_ROW = [INTERNAL + "file", INTERNAL + "row"]


def file_of(depth: int | None = None) -> Column:
    """The path of a row's file, or its last ``depth`` parts, by which files are
    known where a table may be moved as a whole."""
    path = F.col("_metadata.file_path")
    return path if depth is None else F.substring_index(path, "/", -depth)


def with_file_rows(df: DataFrame, depth: int | None = None, root: str | None = None) -> DataFrame:
    """Add ``FILE_ROW``: ids that a parquet scan has without reading a column. They
    are the same however the scan is split, as long as the files are.

    With ``root``, the path of a table, its files count as one, however many there
    are: a row is known by that path, or its last ``depth`` parts, and by its number
    through the files in the order of their paths. One pass that reads no column
    counts the rows of each file; give whole tables, as filtered ones hide rows."""
    file, row = FILE_ROW
    try:
        placed = df.withColumns({file: file_of(None if root else depth), row: F.col("_metadata.row_index")})
    except AnalysisException as error:
        raise ValueError("rows have a place only in a table read from parquet files") from error
    if root is None:
        return placed
    ensure_checkpoint_dir(df.sparkSession)
    sizes = placed.groupBy(file).agg(F.expr(f"max({row}) + 1").alias("rows"))
    # One row per file.
    before = (F.sum("rows").over(Window.orderBy(file)) - F.col("rows")).alias(_BEFORE)
    offsets = sizes.select(file, before).checkpoint()
    path = root.rstrip("/")
    table = path if depth is None else "/".join(path.split("/")[-depth:])
    return placed.join(F.broadcast(offsets), file).select(
        *[F.col(quoted(c)) for c in df.columns], F.lit(table).alias(file), F.expr(f"{row} + {_BEFORE}").alias(row)
    )


def file_chunk(chunk_rows: int, depth: int | None = None) -> Column:
    """The name of a run of ``chunk_rows`` rows of one file: ``path#number``."""
    return _chunk(file_of(depth), F.col("_metadata.row_index"), chunk_rows)


def placed_chunk(chunk_rows: int) -> Column:
    """The same for rows that have ``FILE_ROW``, those of a table's files taken as one."""
    return _chunk(*[F.col(c) for c in FILE_ROW], chunk_rows)


def _chunk(file: Column, row: Column, chunk_rows: int) -> Column:
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be at least 1")
    return F.concat(file, F.lit("#"), F.floor(row / F.lit(chunk_rows)).cast("string"))


def row_position(
    df: DataFrame, order_by: Sequence[str], name: str = "row_position", *, ids: Sequence[str] = ()
) -> DataFrame:
    """Number the rows 1..n by ``order_by``, then by ``ids``, which together must
    tell rows apart; the job stops where they don't. Nulls come first.

    Only these columns are sorted, by a range partitioning that also splits the
    rows of one value, and checkpointed. Each task numbers its own range, the
    ranges' offsets, one row per task, are added, and the numbers are joined back
    to the rows by the same columns.
    """
    keys = list(dict.fromkeys([*order_by, *ids]))
    if name in keys:
        raise ValueError(f"rename the column {name} first")
    ensure_checkpoint_dir(df.sparkSession)
    # monotonically_increasing_id holds the partition above 33 bits of offset.
    placed = (
        df.select(*[F.col(quoted(c)) for c in keys])
        .orderBy(*[F.col(quoted(c)) for c in keys])
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .withColumn(_PART, F.expr(f"shiftright({_PLACE}, 33)"))
        .checkpoint()
    )
    parts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy(_PART)) - F.col("rows")
    offsets = parts.select(_PART, before.alias(_BEFORE))
    # Rows of one key are neighbours in one range.
    above = F.lag(F.struct(*[F.col(quoted(c)) for c in keys])).over(Window.partitionBy(_PART).orderBy(_PLACE))
    same = F.struct(*[F.col(quoted(c)) for c in keys]).eqNullSafe(above)
    message = text("the columns do not tell rows apart; give ids")
    number = F.expr(f"{_BEFORE} + ({_PLACE} & {2**33 - 1}L) + 1")
    numbered = placed.join(F.broadcast(offsets), _PART).withColumn(
        name, F.when(same, F.expr(f"cast(raise_error({message}) as bigint)")).otherwise(number)
    )
    rows = df.drop(name)
    return join_on_keys(rows, numbered.select(*[F.col(quoted(c)) for c in keys], quoted(name)), keys)
