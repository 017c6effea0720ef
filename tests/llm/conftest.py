from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(autouse=True)
def visible(spark):
    """Python tasks find the package from wherever the tests are started."""
    spark.sparkContext.environment["PYTHONPATH"] = str(ROOT)
    sys.path[:0] = [] if str(ROOT) in sys.path else [str(ROOT)]


# Columns with names that operators use inside, next to those of the tables.
_EXTRA = {"n": 7, "node": 1, "key": 2, "label": 3, "budget": 4, "hash": 5, "copies": 6, "digest": "x"}


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (doc_id, text) pairs."""

    def make(rows, lang="en", source="src1", extra=True):
        kind = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
            + [T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
            + [T.StructField(c, T.StringType() if isinstance(v, str) else T.IntegerType()) for c, v in _EXTRA.items() if extra]
        )
        rest = tuple(_EXTRA.values()) if extra else ()
        return spark.createDataFrame([(i, t, lang, source, *rest) for i, t in rows], kind).repartition(3)

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
