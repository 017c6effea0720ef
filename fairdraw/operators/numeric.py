"""Numeric columns: exact quantiles, winsorizing, decile buckets, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairdraw.functions.columns import INTERNAL, columns_of_type, name, report_round, text, to_number
from fairdraw.plans.order_statistics import DOUBLES, number_list, order_statistics, sketch_columns
from fairdraw.sources.scratch import ensure_checkpoint_dir

# The deciles, the share at which tails are cut, the digits to
# which decile limits are rounded, and the prefix of bucket columns.
DECILES = tuple(k / 10 for k in range(1, 11))
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
TAIL = 0.99
DECILE_DIGITS = 2
BUCKET_PREFIX = "bucket_"

_LIMITS = INTERNAL + "limits"


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles, with nulls and unreadable values as 0."""
    numeric = set(columns_of_type(df, "numeric"))
    return df.withColumns({c: to_number(c, c in numeric) for c in columns})


def present(column: str, kind: T.DataType) -> str:
    """SQL text of a numeric column with NaN, which says no number, as null."""
    return f"nullif({name(column)}, double('NaN'))" if isinstance(kind, (T.DoubleType, T.FloatType)) else name(column)


def _exact(kind: T.DataType) -> str | None:
    """The decimal type in which a column is compared exactly; none if doubles do."""
    if isinstance(kind, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        return "decimal(20, 0)"
    if isinstance(kind, T.DecimalType):
        return f"decimal({min(kind.precision + 1, 38)}, {kind.scale})"
    return None


def _as_exact(column: str, kind: T.DataType) -> str:
    """SQL text of the column in its type for comparisons."""
    value = name(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = f"unix_micros(cast({value} as timestamp))"
    exact = _exact(kind)
    return f"cast({value} as {exact})" if exact else f"cast({present(column, kind)} as double)"


def _located(df: DataFrame, columns: Sequence[str], ranks: str, many: int) -> DataFrame:
    """Order statistics of several columns, those of one type in the same passes."""
    kinds: dict[str | None, list[str]] = {}
    for c in columns:
        kinds.setdefault(_exact(df.schema[c].dataType), []).append(c)
    found = None
    for exact, some in kinds.items():
        pairs = ", ".join(f"{text(c)}, {_as_exact(c, df.schema[c].dataType)}" for c in some)
        values = df.select(F.expr(f"stack({len(some)}, {pairs}) as (column, x)")).where("x is not null")
        ends = DOUBLES
        if exact:
            digits, scale = (int(part) for part in exact[8:-1].split(","))
            most = "9" * (digits - scale) + (f".{'9' * scale}" if scale else "")
            ends = f"cast('-{most}' as {exact})", f"cast('{most}' as {exact})"
        sketched = sketch_columns(df, {c: _as_exact(c, df.schema[c].dataType) for c in some}, "column")
        part = order_statistics(values, ["column"], ranks, many, ends, sketched)
        found = part if found is None else found.unionByName(part)
    return found


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    clip_at: float | None = None,
) -> DataFrame:
    """Exact quantiles by linear interpolation: ``column, probability, value``.

    Nulls and NaN are left out. With ``clip_at`` they are the quantiles of the
    column after values above that quantile were set to it. Whole numbers and
    decimals are put in order exactly; what lies between two is a double.
    """
    wanted = sorted({*probabilities, *([] if clip_at is None else [clip_at])})
    ranks = f"""transform({number_list(wanted)}, p -> struct(
        p as target,
        cast(floor((n - 1) * p) as bigint) + 1 as rank,
        least(cast(floor((n - 1) * p) as bigint) + 2, n) as next_rank))"""
    found = _located(df, columns, ranks, len(wanted))
    found = found.withColumns({c: F.col(c).cast("double") for c in ("x_at", "x_next")})
    part = "((n - 1) * target - (rank - 1))"

    def between(low: str, high: str) -> str:
        return f"{low} + ({high} - {low}) * {part}"

    if clip_at is None:
        value = F.expr(between("x_at", "x_next"))
    else:
        # A few rows per column share the window.
        tail = F.expr(f"if(target = {clip_at!r}D, {between('x_at', 'x_next')}, null)")
        found = found.withColumn("tail", F.max(tail).over(Window.partitionBy("column")))
        value = F.expr(between("least(x_at, tail)", "least(x_next, tail)"))
    return found.where(F.col("target").isin([float(p) for p in probabilities])).select(
        "column", F.col("target").alias("probability"), value.alias("value")
    )


def _number(value: float | None) -> str:
    """SQL text of a constant double."""
    return "cast(null as double)" if value is None else f"double('{value!r}')"


def _limits_of(table: DataFrame) -> dict[str, list[Row]]:
    """The quantiles of each column, exact and rounded, in ascending order.

    They are a few numbers per column, whatever the data, and are looked up here:
    as constants they keep the code that meets every row short enough to be compiled,
    and the passes behind them are run once."""
    found = table.withColumn("rounded", report_round(F.col("value"), DECILE_DIGITS)).orderBy("probability").collect()
    limits: dict[str, list[Row]] = {}
    for row in found:
        limits.setdefault(row["column"], []).append(row)
    return limits


def _limit(limits: dict[str, list[Row]], column: str, position: int, kind: str) -> str:
    """SQL text of a limit; null for a column without numbers."""
    return _number(limits[column][position][kind] if column in limits else None)


def _clipped(df: DataFrame, column: str, limit: str) -> Column:
    value = present(column, df.schema[column].dataType)
    return F.expr(f"if({value} is null, cast({name(column)} as double), least(cast({name(column)} as double), {limit}))")


def winsorize(
    df: DataFrame,
    columns: Sequence[str],
    tail: float = TAIL,
    *,
    population: DataFrame | None = None,
) -> DataFrame:
    """Set values above the tail quantile to it, column by column; NaN, which is
    above nothing, stays. The quantile is that of ``population``, or else of the
    table itself."""
    limits = _limits_of(quantiles(df if population is None else population, columns, [tail]))
    return df.withColumns({c: _clipped(df, c, _limit(limits, c, 0, "value")) for c in columns})


def deciles(df: DataFrame, columns: Sequence[str], *, clip_at: float | None = None) -> DataFrame:
    """The ten deciles of each column, rounded: ``column, probability, value``."""
    table = quantiles(df, columns, DECILES, clip_at=clip_at)
    return table.withColumn("value", report_round(F.col("value"), DECILE_DIGITS))


def _bucket(value: str, limits: Sequence[str]) -> str:
    """SQL text of the bucket of a value: 0.1 below the second decile, then the
    highest decile reached, at most 0.9. ``limits`` are those of the deciles."""
    steps = " ".join(f"when {value} < {limits[k]} then {k / 10!r}D" for k in range(1, 9))
    return f"case when {value} is null then null {steps} else 0.9D end"


def decile_buckets(
    df: DataFrame,
    columns: Sequence[str],
    *,
    clip_at: float | None = None,
    prefix: str = BUCKET_PREFIX,
) -> DataFrame:
    """Add a bucket column per numeric column: nine buckets, the first holding
    the two lowest tenths; none for null and NaN. With ``clip_at`` the columns are winsorized there,
    in the result too; the highest decile of a clipped column is its tail."""
    limits = _limits_of(quantiles(df, columns, DECILES, clip_at=clip_at))
    rounded = {c: [_limit(limits, c, k, "rounded") for k in range(len(DECILES))] for c in columns}
    buckets = {prefix + c: F.expr(_bucket(present(c, df.schema[c].dataType), rounded[c])) for c in columns}
    clipped = {} if clip_at is None else {c: _clipped(df, c, _limit(limits, c, 9, "value")) for c in columns}
    return df.withColumns({**buckets, **clipped})


def position_buckets(df: DataFrame, order_by: str, bucket: str = "position_bucket") -> DataFrame:
    """Bucket the row positions 1..n under an order like decile buckets.

    The deciles of 1..n are known in closed form, so only the order values at
    eight positions are looked up; no rows are numbered or sorted. The order
    column must be numeric or a timestamp and is compared exactly; equal values
    share a bucket, and rows without a value have the last one.
    """
    scale = float(10**DECILE_DIGITS)
    place = f"cast(ceil(floor((1 + (n - 1) * p) * {scale!r}D + 0.5D) / {scale!r}D) as bigint)"
    ranks = f"""transform({number_list(DECILES[1:9])}, p -> struct(
        p as target, {place} as rank, {place} as next_rank))"""
    found = _located(df, [order_by], ranks, 8)
    entry = F.struct("target", "x_at")
    ensure_checkpoint_dir(df.sparkSession)
    limits = found.agg(F.array_sort(F.collect_list(entry)).alias("limits")).checkpoint().scalar()
    value = _as_exact(order_by, df.schema[order_by].dataType)
    steps = " ".join(
        f"when {value} < {_LIMITS}[{k - 1}].x_at then {k / 10!r}D" for k in range(1, 9)
    )
    return (
        df.withColumn(_LIMITS, limits)
        .withColumn(bucket, F.expr(f"case {steps} else 0.9D end"))
        .drop(_LIMITS)
    )


def _measures(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """Per column: ``n, min, mean, max`` and the named quantiles. The quantile
    table has a few rows per column."""
    pairs = ", ".join(f"{text(c)}, cast({present(c, df.schema[c].dataType)} as double)" for c in columns)
    values = df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, x)"))
    moments = values.groupBy("column").agg(
        F.count("x").alias("n"), F.min("x").alias("min"), F.avg("x").alias("mean"), F.max("x").alias("max")
    )
    placed = quantiles(df, columns, sorted(set(shares.values()))).groupBy("column").agg(
        *[F.expr(f"max(if(probability = {p!r}D, value, null))").alias(label) for label, p in shares.items()]
    )
    return moments.join(F.broadcast(placed), "column", "left")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, min, q1, median, mean, q3, max``; nulls and NaN are left out."""
    return _measures(df, columns, QUARTILES).select("column", "n", "min", "q1", "median", "mean", "q3", "max")


def numeric_before_after(population: DataFrame, sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Summary and deciles of both tables side by side:
    ``column, measure, population, sample``. Sixteen rows per column.

    The columns of the sample are checkpointed first, as quantiles take
    several passes and a sample is dear to draw again.
    """
    tenths = {f"decile_{k}": p for k, p in enumerate(DECILES, 1)}
    names = ["min", "q1", "median", "mean", "q3", "max", *tenths]

    def long(df: DataFrame, value: str) -> DataFrame:
        found = _measures(df, columns, {**QUARTILES, **tenths})
        for label in tenths:
            found = found.withColumn(label, report_round(F.col(label), DECILE_DIGITS))
        pairs = ", ".join(f"'{n}', {n}" for n in names)
        return found.select("column", F.expr(f"stack({len(names)}, {pairs}) as (measure, {value})"))

    ensure_checkpoint_dir(sample.sparkSession)
    drawn = sample.select(*columns).checkpoint()
    return long(population, "population").join(
        F.broadcast(long(drawn, "sample")), ["column", "measure"], "left"
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_null`` in one pass over all columns; NaN counts as null."""
    columns = df.columns if columns is None else list(columns)
    values = {c: present(c, df.schema[c].dataType) for c in columns}
    counted = df.agg(*[F.expr(f"count_if({values[c]} is null)").alias(f"n_{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"{text(c)}, n_{i}" for i, c in enumerate(columns))
    return counted.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, n_null)"))
