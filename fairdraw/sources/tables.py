"""Reading populations and writing samples and reports."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, **options: object
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads
    the files once more."""
    reader = spark.read.options(header=True, **options)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table, ``table`` or ``schema.table``."""
    return spark.table(table)


def from_local(spark: SparkSession, frame: pd.DataFrame, view: str | None = None) -> DataFrame:
    """Push a small local table to Spark, under a view name if one is given."""
    df = spark.createDataFrame(frame)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def register(df: DataFrame, view: str, keep: bool = False) -> DataFrame:
    """Name a table for SQL. A view alone recomputes the table on each use;
    ``keep`` persists it on the executors."""
    if keep:
        df = df.persist()
    df.createOrReplaceTempView(view)
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def fetch(sample: DataFrame, max_rows: int = 1_000_000) -> pd.DataFrame:
    """A sample as a local table; refuses tables over ``max_rows`` rows."""
    local = sample.limit(max_rows + 1).toPandas()
    if len(local) > max_rows:
        raise ValueError(f"the table has more than {max_rows} rows; write it instead")
    return local


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows under an order."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order_by]).limit(rows)
