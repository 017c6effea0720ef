"""Row numbers from narrow sorts, and rows known by their place in files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fairdraw.operators import chunks, positions, sampling


def test_ties_are_split_by_ids_and_nulls_come_first(spark):
    # A third of the rows have one value.
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id end as v", "'wide' as w")
    df = df.repartition(5)
    got = positions.row_position(df, ["v"], ids=["id"])
    assert got.columns == ["id", "v", "w", "row_position"]
    rows = sorted(got.collect(), key=lambda r: r.row_position)
    assert [r.row_position for r in rows] == list(range(1, 3001))
    assert rows == sorted(rows, key=lambda r: (r.v is not None, r.v or 0, r.id))


def test_one_value_is_spread_over_the_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 0, id) as v")
        placed = df.orderBy("v", "id").groupBy(F.spark_partition_id()).count()
        assert placed.agg(F.max("count")).collect()[0][0] <= 0.05 * 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_columns_that_do_not_tell_rows_apart_are_refused(spark):
    df = spark.range(10).selectExpr("id div 2 as v", "id")
    with pytest.raises(Exception, match="give ids"):
        positions.row_position(df, ["v"]).collect()
    with pytest.raises(ValueError, match="rename"):
        positions.row_position(df, ["v"], "v")
    assert positions.row_position(df.where("false"), ["id"]).collect() == []


def test_only_narrow_columns_are_written(spark, monkeypatch):
    written, plain = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda self, *a: written.append(self.columns) or plain(self, *a))
    positions.row_position(spark.range(9).selectExpr("id", "id as k", "'x' as wide"), ["k"], ids=["id"]).collect()
    assert len(written) == 1 and "wide" not in written[0]


@pytest.fixture
def files(spark, tmp_path):
    spark.range(5000).selectExpr("id", "cast(id % 7 as string) as a", "if(id % 3 = 0, 'hot', 'x') as b").repartition(4).write.parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t"


def test_rows_of_files_are_drawn_alike_however_they_are_split(spark, files):
    found = []
    for split in ("128m", "20k", "6k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            drawn = sampling.random_order_sample(spark.read.parquet(files), ["a", "b"], 0.1, 3)
            found.append(sorted(r.id for r in drawn.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] == found[2] and len(found[0]) == len(set(found[0])) > 480


def test_filters_and_projections_keep_the_place(spark, files):
    df = spark.read.parquet(files)
    place = {r.id: tuple(r[1:]) for r in positions.with_file_rows(df.select("id"), 1).collect()}
    assert len(set(place.values())) == 5000
    half = positions.with_file_rows(df.where("id % 2 = 0").withColumn("c", F.lit(1)), 1).select("id", *positions.FILE_ROW)
    assert all(place[r.id] == tuple(r[1:]) for r in half.collect())


def test_tables_without_files_are_told(spark):
    with pytest.raises(ValueError, match="parquet"):
        positions.with_file_rows(spark.range(3))


def test_chunks_of_files_have_their_rows(spark, files):
    chunked = spark.read.parquet(files).withColumn("c", positions.file_chunk(100, 1)).groupBy("c").count()
    sizes = [r["count"] for r in chunked.collect()]
    assert sum(sizes) == 5000 and max(sizes) == 100 and sum(s < 100 for s in sizes) <= 4
    drawn = chunks.chunk_sample(spark.read.parquet(files), ["b"], positions.file_chunk(100), 0.05, 2, ids=["id"])
    assert drawn.groupBy("chunk_id", "b").count().where("count < 2").count() <= 8
    with pytest.raises(ValueError):
        positions.file_chunk(0)


def test_a_table_of_many_files_is_drawn_like_one_file(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "cast(id % 7 as string) as a", "if(id % 3 = 0, 'hot', 'x') as b")
    one, many = f"{tmp_path}/one/t", f"{tmp_path}/many/t"
    rows.coalesce(1).write.parquet(one)
    rows.coalesce(1).write.option("maxRecordsPerFile", 900).parquet(many)
    assert len(spark.read.parquet(many).inputFiles()) == 6
    drawn, numbers, chunked = [], [], []
    for root in (one, many):
        df = spark.read.parquet(root)
        drawn.append(sorted(r.id for r in sampling.random_order_sample(df, ["a", "b"], 0.1, depth=1, root=root).collect()))
        placed = positions.with_file_rows(df, 1, f"{root}/")
        numbers.append(sorted(tuple(r) for r in placed.select("id", *positions.FILE_ROW).collect()))
        chunked.append(sorted(tuple(r) for r in placed.select("id", positions.placed_chunk(2000)).collect()))
    assert drawn[0] == drawn[1] and chunked[0] == chunked[1]
    assert numbers[0] == numbers[1] == [(i, "t", i) for i in range(5000)]
