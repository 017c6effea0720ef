import pytest
from draws import priority
from pyspark.sql import functions as F

from fairdraw.operators import chunks, drift, merge, numeric, periods, profile
from fairdraw.plans.quota import Quota


def levels(spark, **counts):
    rows = [(None if k == "null" else k,) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "c string")


def test_status_limits(spark):
    population = levels(spark, a=500, b=500)
    for moved, two, three in ((20, "OK", "WATCH"), (19, "OK", "OK"), (49, "OK", "WATCH"), (50, "DRIFT", "DRIFT")):
        sample = levels(spark, a=500 + moved, b=500 - moved)
        assert {r.status for r in drift.drift_two_tier(population, sample, ["c"]).collect()} == {two}
        assert {r.status for r in drift.drift_three_tier(population, sample, ["c"]).collect()} == {three}


def test_levels_missing_on_one_side(spark):
    report = drift.drift_raw(levels(spark, a=8, b=2), levels(spark, a=4, x=1), ["c"]).collect()
    found = {r.level: (r.pop_pct, r.samp_pct) for r in report}
    assert found == {"a": (0.8, 0.8), "b": (0.2, 0.0), "x": (0.0, 0.2)}


def test_missing_level_is_reported(spark):
    report = drift.drift_raw(levels(spark, a=1, null=3), levels(spark, a=1), ["c"]).collect()
    assert {r.level for r in report} == {"a", "__NA__"}


def test_empty_sample(spark):
    report = drift.drift_two_tier(levels(spark, a=3), levels(spark, a=1).where("false"), ["c"]).collect()
    assert [(r.samp_pct, r.status) for r in report] == [(0.0, "DRIFT")]


def test_flagged_and_separate_reports_agree(spark):
    df = spark.range(1000).select("id", F.expr("concat('l', id % 7)").alias("c"), F.expr("id % 3 = 0").alias("hit"))
    flagged = drift.compare_flagged(df, F.col("hit"), ["c"]).select("level", "pop_pct", "samp_pct")
    apart = drift.compare_levels(df, df.where("hit"), ["c"]).select("level", "pop_pct", "samp_pct")
    assert sorted(map(tuple, flagged.collect())) == sorted(map(tuple, apart.collect()))


def test_summary_and_verdict(spark):
    report = drift.drift_two_tier(levels(spark, a=500, b=500), levels(spark, a=530, b=470), ["c"])
    row = drift.drift_summary(report).collect()[0]
    assert (row.max_drift_pct, row.n_drifted, row.verdict) == (3.0, 0, "PASS")
    assert drift.drift_summary(report, max_drift_pct=2.0).collect()[0].verdict == "REVIEW"


def test_representation_of_an_absent_level(spark):
    rows = drift.level_representation(levels(spark, a=10), levels(spark, a=4), "c", ["a", "z"]).collect()
    assert {r.level: (r.pop_n, r.samp_n, r.kept_pct) for r in rows} == {"a": (10, 4, 40.0), "z": (0, 0, 0.0)}


def test_rare_is_strictly_below_the_threshold(spark):
    df = levels(spark, a=80, edge=10, below=9, null=1)
    merged = merge.merge_rare_levels(df, "c", "Other", threshold=0.1)
    counts = {r.c: r["count"] for r in merged.groupBy("c").count().collect()}
    assert counts == {"a": 80, "edge": 10, "Other": 9, None: 1}
    with_nulls = merge.merge_rare_levels(df, "c", "Other", threshold=0.1, merge_nulls=True)
    counts = {r.c: r["count"] for r in with_nulls.groupBy("c").count().collect()}
    assert counts == {"a": 80, "edge": 10, "Other": 10}


@pytest.mark.parametrize("limit", [20_000, 1])
def test_merge_by_count_on_both_lookups(spark, limit):
    df = levels(spark, a=30, b=20, d=10, e=9, null=12)
    merged = merge.merge_rare_levels(df, "c", "Other", threshold=None, min_count=10, broadcast_keys=limit)
    counts = {(r.c, r.c_original): r["count"] for r in merged.groupBy("c", "c_original").count().collect()}
    assert counts == {("a", "a"): 30, ("b", "b"): 20, ("d", "d"): 10, ("Other", "e"): 9, (None, None): 12}


def test_audit_counts_original_levels(spark):
    merged = merge.merge_rare_levels(levels(spark, a=90, b=6, d=4), "c", "Other", threshold=0.1)
    assert [tuple(r) for r in merge.merge_audit(merged, "c", "Other").collect()] == [("b", 6), ("d", 4)]
    row = merge.strata_before_after(merged, ["c"], "c").collect()[0]
    assert tuple(row) == (3, 2, 1)


def test_merge_needs_one_rule(spark):
    with pytest.raises(ValueError):
        merge.level_table(levels(spark, a=1), "c", "Other", threshold=0.1, min_count=3)
    with pytest.raises(ValueError):
        merge.level_table(levels(spark, a=1), "c", "Other", threshold=None)


def test_profile_of_strata(spark):
    row = profile.strata_profile(levels(spark, a=1, b=2, d=4, e=9, f=10, null=1), ["c"]).collect()[0]
    assert row.asDict() == {"n_strata": 6, "n_size_1": 2, "n_size_2": 1, "n_under_5": 4, "n_under_10": 5}


def test_floor_per_chunk_and_global(spark):
    df = spark.range(100).select("id", F.expr("if(id % 50 = 0, 'rare', 'common')").alias("s"))
    chunk = F.expr("id div 50")
    per_chunk = chunks.chunk_sample(df, ["s"], chunk, 0.1, ids=["id"])
    overall = chunks.chunk_sample(df, ["s"], chunk, 0.1, floor_scope="global", ids=["id"])
    assert per_chunk.where("s = 'rare'").count() == 2 and overall.where("s = 'rare'").count() == 1
    with pytest.raises(ValueError):
        chunks.chunk_sample(df, ["s"], chunk, 0.1, floor_scope="file", ids=["id"])


def test_chunks_of_consecutive_rows(spark):
    df = spark.range(25).select(F.expr("id * 10").alias("k")).repartition(4)
    chunked = chunks.chunk_of_position(df, ["k"], 10).groupBy("chunk_id").agg(F.count("k"), F.min("k"), F.max("k"))
    assert sorted(map(tuple, chunked.collect())) == [(0, 10, 0, 90), (1, 10, 100, 190), (2, 5, 200, 240)]


def test_first_period_wins(spark):
    first = spark.createDataFrame([(1, 7, "s"), (2, 8, "s")], "id bigint, user bigint, s string")
    second = spark.createDataFrame([(3, 7, "s"), (4, 9, "s"), (5, None, "s")], "id bigint, user bigint, s string")
    drawn = periods.period_sample(
        [("one", first, ["s"]), ("two", second, ["s"])], Quota(n=10), ["user"], ids=["id"]
    )
    assert sorted((r.id, r.period) for r in drawn.collect()) == [(1, "one"), (2, "one"), (4, "two"), (5, "two")]


def test_a_level_named_like_a_missing_one_keeps_apart(spark):
    df = spark.createDataFrame([("__NA__",), (None,), (None,), ("a",)], "c string")
    counted = profile.level_shares(df, ["c"]).collect()
    assert sorted((r.level, r.n) for r in counted) == [("__NA__", 1), ("__NA__", 2), ("a", 1)]
    report = drift.compare_levels(df, df.where("c is null"), ["c"]).collect()
    assert sorted((r.level, r.pop_n, r.samp_n) for r in report) == [("__NA__", 1, 0), ("__NA__", 2, 2), ("a", 1, 0)]


def test_all_levels_are_reported(spark):
    df = spark.range(3000).select(F.expr("concat('level, ', id div 2)").alias("odd `name"))
    row = merge.merge_report(df, "odd `name", "Other", threshold=None, min_count=3).collect()[0]
    assert (row.n_merged, row.n_kept, row.rows_merged) == (1500, 0, 3000)
    table = merge.level_table(df, "odd `name", "Other", threshold=None, min_count=3)
    assert table.count() == 1500 and table.where("is_rare and label_new = 'Other'").count() == 1500


def test_names_that_clash_are_refused_or_harmless(spark):
    df = levels(spark, a=90, b=10)
    with pytest.raises(ValueError, match="c_original"):
        merge.merge_rare_levels(df.withColumn("c_original", F.lit(1)), "c", "Other")
    with pytest.raises(ValueError, match="pct"):
        merge.level_table(df.withColumnRenamed("c", "pct"), "pct", "Other")
    for limits in ({"threshold": 0.2}, {"threshold": None, "min_count": 20}):
        merged = merge.merge_rare_levels(df.withColumnRenamed("c", "n"), "n", "Other", **limits)
        assert {r.n: r["count"] for r in merged.groupBy("n").count().collect()} == {"a": 90, "Other": 10}
    with pytest.raises(ValueError, match="chunk_id"):
        chunks.chunk_sample(df.withColumn("chunk_id", F.lit(1)), ["chunk_id"], F.lit(0), 0.1)


def test_a_kept_level_called_other_is_not_in_the_audit(spark):
    merged = merge.merge_rare_levels(levels(spark, Other=60, a=30, b=6, d=4), "c", "Other", threshold=0.1)
    assert merged.where("c = 'Other'").count() == 70
    assert [tuple(r) for r in merge.merge_audit(merged, "c", "Other").collect()] == [("b", 6), ("d", 4)]


@pytest.mark.parametrize("groups", [1, 7, 1 << 20])
def test_first_row_of_every_entity(spark, monkeypatch, groups):
    monkeypatch.setattr(periods, "GROUPS", groups)
    rows = [(i, None if i % 50 == 0 else 0 if i % 3 == 0 else i // 2 * 2, (i * 7) % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, entity int, turn int").repartition(5)
    got = periods.first_per_entity(df, ["entity"], ["turn"], ["id"], seed=3)
    assert got.columns == df.columns
    best = {}
    for i, e, t in rows:
        key = (t, priority(3, i), i)
        best[e] = min(best.get(e, key), key)
    assert sorted((r.id for r in got.collect())) == sorted(k[2] for k in best.values())


def test_periods_are_drawn_once(spark, tmp_path):
    rows = spark.range(400).selectExpr("id", "id % 150 as who", "id % 3 as a", "cast(id as double) as v")
    rows.write.parquet(f"{tmp_path}/t")
    bucketed = numeric.decile_buckets(spark.read.parquet(f"{tmp_path}/t"), ["v"])
    drawn = periods.period_sample(
        [("one", bucketed, ["bucket_v"]), ("two", bucketed, ["a"])], Quota(pct=0.5), ["who"], ids=["id"]
    )
    # Neither the passes over entities nor later ones read the tables again.
    assert drawn.inputFiles() == []
    assert drawn.count() == drawn.select("who").distinct().count() > 100
    # Limits are constants: every use of a bucket would look them up once more.
    assert "map" not in bucketed._jdf.queryExecution().optimizedPlan().toString()
