"""The registered queries next to their SQL, and the pipeline, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from samples import FOLDER

import __spark_entry__ as registered
import corpus_pipeline
from fairdraw.llm import decontaminate, minhash, queries
from tools.check import database, difference

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_all_are_registered():
    names = registered.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, database(FOLDER).execute(queries.ORACLE_SQL[name]).df()) == ""


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, FOLDER)
        result.write.parquet(f"{tmp_path}/{number}")
        given, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert docs.columns == columns and docs.exceptAll(given).count() == 0, name
        assert 0 < docs.count() <= before
        before = docs.count()
        if name == "near_duplicates":
            assert minhash.near_duplicates(docs).where("not kept").count() == 0
        if name == "decontamination":
            assert decontaminate.contaminated(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, rows))
