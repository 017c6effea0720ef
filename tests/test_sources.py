import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fairdraw.functions.columns import columns_of_type
from fairdraw.operators import sampling
from fairdraw.sources import tables
from fairdraw.streaming import micro_batches
from tools import viewing


@pytest.fixture(scope="module")
def views(spark):
    return viewing.generate_population(spark, 20_000, "v2").cache()


def test_population_has_structural_nulls(views):
    assert views.where("(ContentType = 'Sports') <> (SportsName is not null)").count() == 0
    assert views.where("(ContentType = 'Sports') <> (Genre is null)").count() == 0
    assert views.where("(Genre is null) <> (Language is null)").count() == 0


def test_population_shares(views):
    shares = {r.Country: r["count"] / 20_000 for r in views.groupBy("Country").count().collect()}
    for country, share in viewing.COUNTRIES_V2.items():
        assert shares[country] == pytest.approx(share, abs=0.012)
    row = views.agg(F.avg("TotalMins"), F.avg("TotalCNT"), F.min("UserID"), F.max("UserID")).collect()[0]
    assert row[0] == pytest.approx(50, rel=0.05) and row[1] == pytest.approx(500, rel=0.05)
    assert (row[2], row[3]) == (101, 300)
    assert views.select(*viewing.STRATA).distinct().count() <= 336


def test_population_is_the_same_under_any_partitioning(spark):
    one = viewing.viewing_population(spark.range(500).coalesce(1), "id", "v1")
    many = viewing.viewing_population(spark.range(500).repartition(9), "id", "v1")
    assert one.exceptAll(many).count() == 0


def test_sparse_countries_survive_the_floor(views):
    drawn = sampling.floor_sample(views, viewing.STRATA, 0.01, ids=["row_id"])
    strata = views.select(*viewing.STRATA).distinct().count()
    assert drawn.select(*viewing.STRATA).distinct().count() == strata


def test_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(2**60, "a", None), (1, None, 2.5)], "id bigint, s string, x double")
    tables.write_csv(df, str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    assert tables.read_csv(spark, str(tmp_path / "c")).schema["id"].dataType.simpleString() == "bigint"
    tables.write_parquet(df, str(tmp_path / "p"))
    tables.write_parquet(df, str(tmp_path / "p"))
    assert tables.read_parquet(spark, str(tmp_path / "p")).count() == 2


def test_views_local_tables_and_fetch(spark):
    df = tables.from_local(spark, pd.DataFrame({"k": [1, 2, 3], "s": ["a", "b", "c"]}), "local_rows")
    assert tables.read_table(spark, "local_rows").count() == 3
    assert len(tables.fetch(df, 3)) == 3
    with pytest.raises(ValueError):
        tables.fetch(df, 2)
    assert [r.k for r in tables.preview(df, ["k"], 2).collect()] == [1, 2]
    assert columns_of_type(df, "numeric") == ["k"] and columns_of_type(df, "text") == ["s"]


def test_stream_is_sampled_batch_by_batch(spark, tmp_path):
    rows = spark.range(300).select("id", F.expr("concat('s', id % 3)").alias("s"))
    for i in range(3):
        part = rows.where(f"id div 100 = {i}").coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = micro_batches.sample_stream(
        stream, ["s"], 0.1, ids=["id"], path=str(tmp_path / "out"), checkpoint=str(tmp_path / "state")
    )
    query.awaitTermination()
    drawn = micro_batches.read_stream_sample(spark, str(tmp_path / "out"), rows)
    sizes = {r.batch_id: r["count"] for r in drawn.groupBy("batch_id").count().collect()}
    assert sizes == {0: 9, 1: 9, 2: 9}
    for i in range(3):
        batch = rows.where(f"id div 100 = {i}")
        expected = sampling.floor_sample(batch, ["s"], 0.1, ids=["id"]).select("id")
        assert {r.id for r in expected.collect()} <= {r.id for r in drawn.collect()}


@pytest.mark.parametrize("files", [1, 5])
def test_whole_stream_is_drawn_like_its_table(spark, tmp_path, files):
    rows = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 41 as string)) as s")
    rows.repartition(files).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = micro_batches.sample_whole_stream(stream, ["s"], 0.05, 3, ids=["id"], path=f"{tmp_path}/out", checkpoint=f"{tmp_path}/state")
    query.awaitTermination()
    got = micro_batches.read_whole_stream_sample(spark, f"{tmp_path}/out", rows, 0.05, ids=["id"])
    low = sampling.native_sample(rows, "s", 0.05, ids=["id"])
    floor = sampling.fixed_sample(rows, ["s"], 3, ids=["id"])
    assert sorted(got.collect()) == sorted(low.union(floor).distinct().collect())
    assert len([p for p in os.listdir(f"{tmp_path}/out") if p.startswith("state")]) == min(files, 2)
