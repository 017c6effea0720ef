import numpy as np
import pytest
from pyspark.sql import functions as F

from fairdraw.operators import numeric, positions, sampling
from fairdraw.plans import order_statistics as stats

P = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def quantiles(df, columns, probabilities=P, **options):
    rows = numeric.quantiles(df, columns, probabilities, **options).collect()
    return {(r.column, r.probability): r.value for r in rows}


@pytest.fixture(scope="module")
def shapes(spark):
    """Columns with an atom of a third, long tails, few values, negatives."""
    rng = np.random.default_rng(3)
    n = 60_000
    data = {
        "even": rng.random(n),
        "atom": np.where(rng.random(n) < 1 / 3, 0.0, rng.exponential(50, n)),
        "tail": rng.lognormal(0, 4, n),
        "few": rng.integers(0, 4, n).astype(float),
        "signed": rng.normal(-5, 30, n).round(1),
        "same": np.full(n, 7.0),
    }
    import pandas as pd

    return data, spark.createDataFrame(pd.DataFrame(data)).repartition(6).cache()


@pytest.mark.parametrize("grid", [500, 20])
def test_quantiles_equal_numpy(shapes, monkeypatch, grid):
    data, df = shapes
    monkeypatch.setattr(stats, "GRID", grid)
    monkeypatch.setattr(stats, "SMALL", 20 * grid)
    found = quantiles(df, list(data))
    for column, values in data.items():
        for p in P:
            assert found[column, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_brackets_are_narrowed_while_they_hold_many_rows(shapes, monkeypatch):
    data, df = shapes
    monkeypatch.setattr(stats, "GRID", 20)
    monkeypatch.setattr(stats, "SMALL", 8)
    monkeypatch.setattr(stats, "FEW", 5)
    calls, plain = [], stats._narrowed
    monkeypatch.setattr(stats, "_narrowed", lambda *a: calls.append(1) or plain(*a))
    found = quantiles(df, list(data))
    assert len(calls) >= 3
    for column, values in data.items():
        for p in P:
            assert found[column, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 3.0, 3.0, 9.0], list(range(11))])
def test_quantiles_of_few_rows(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = quantiles(df, ["x"])
    for p in P:
        assert found["x", p] == pytest.approx(np.quantile(values, p))


def test_nulls_are_left_out_and_empty_columns_absent(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    found = quantiles(df, ["x", "y"], [0.5])
    assert found == {("x", 0.5): 2.0}


def test_clipped_quantiles_equal_those_of_the_winsorized_column(spark):
    for n in (5, 40, 300):
        values = np.random.default_rng(n).exponential(10, n)
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        tail = np.quantile(values, 0.99)
        found = quantiles(df, ["x"], list(numeric.DECILES), clip_at=0.99)
        for p in numeric.DECILES:
            assert found["x", p] == pytest.approx(np.quantile(np.minimum(values, tail), p))
        cut = sorted(r.x for r in numeric.winsorize(df, ["x"]).collect())
        assert cut == pytest.approx(sorted(np.minimum(values, tail)))


def test_buckets(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,)], "x double")
    counted = {r.bucket_x: r["count"] for r in numeric.decile_buckets(df, ["x"]).groupBy("bucket_x").count().collect()}
    assert counted == {None: 1, 0.1: 20, **{k / 10: 10 for k in range(2, 9)}, 0.9: 10}


def test_coercion(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",), (" 2 ",)], "x string")
    assert [r.x for r in numeric.coerce_numbers(df, ["x"]).collect()] == [1.5, 0.0, 0.0, 0.0, 2.0]


def test_position_buckets_follow_row_numbers(spark):
    n = 137
    df = spark.range(n).select((F.col("id") * 3 + 5).alias("k")).repartition(5)
    limits = [np.floor((1 + (n - 1) * k / 10) * 100 + 0.5) / 100 for k in range(1, 11)]
    found = {r.k: r.position_bucket for r in numeric.position_buckets(df, "k").collect()}
    for position in range(1, n + 1):
        wanted = max([k / 10 for k in range(2, 10) if position >= limits[k - 1]], default=0.1)
        assert found[(position - 1) * 3 + 5] == wanted


def test_row_positions(spark):
    df = spark.range(1000).select(F.expr("1000 - id").alias("k")).repartition(7)
    numbered = positions.row_position(df, ["k"]).collect()
    assert sorted((r.k, r.row_position) for r in numbered) == [(i, i) for i in range(1, 1001)]


def test_position_sample_keeps_other_columns(spark):
    df = spark.range(400).select("id", F.expr("cast(id as double)").alias("v"), F.expr("date'2024-01-01'").alias("d"))
    drawn = sampling.position_sample(df, "id", 40, ids=["id"])
    assert drawn.columns == ["id", "v", "d"]
    assert drawn.agg(F.max("v")).collect()[0][0] <= np.quantile(np.arange(400), 0.99)
    assert abs(drawn.count() - 40) <= 9


def test_summary_and_null_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (6.0, None)], "x double, s string")
    row = numeric.numeric_summary(df, ["x"]).collect()[0]
    assert (row.n, row.min, row.q1, row.median, row["mean"], row.q3, row.max) == (3, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0)
    assert {r.column: r.n_null for r in numeric.null_counts(df).collect()} == {"x": 0, "s": 2}


def test_before_after_of_the_whole_table_agree(spark):
    df = spark.range(500).select(F.col("id").cast("double").alias("x"))
    rows = numeric.numeric_before_after(df, df, ["x"]).collect()
    assert len(rows) == 16 and all(r.population == r.sample for r in rows)


def test_nan_says_no_number(spark):
    nan = float("nan")
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(nan,), (None,)], "x double")
    plain = df.where("x is not null and not isnan(x)")
    assert quantiles(df, ["x"]) == quantiles(plain, ["x"])
    row = numeric.numeric_summary(df, ["x"]).collect()[0]
    assert (row.n, row.max, row["mean"]) == (100, 100.0, 50.5)
    assert numeric.deciles(df, ["x"]).collect() == numeric.deciles(plain, ["x"]).collect()
    cut = [r.x for r in numeric.winsorize(df, ["x"]).collect()]
    assert sum(v is None for v in cut) == 1 and sum(v is not None and v != v for v in cut) == 1
    assert sorted(v for v in cut if v is not None and v == v) == sorted(r.x for r in numeric.winsorize(plain, ["x"]).collect())
    buckets = {r.bucket_x: r["count"] for r in numeric.decile_buckets(df, ["x"]).groupBy("bucket_x").count().collect()}
    assert buckets == {None: 2, 0.1: 20, **{k / 10: 10 for k in range(2, 9)}, 0.9: 10}
    assert numeric.null_counts(df).collect()[0].n_null == 2


def test_large_keys_decimals_and_times_are_put_in_order_exactly(spark):
    start = 2**60
    df = spark.range(start, start + 20_001).select(
        "id", F.expr(f"cast(id - {start} as decimal(30, 5)) / 1000 + cast('12345678901234567.5' as decimal(30, 5))").alias("d")
    ).repartition(5)
    assert quantiles(df, ["id"], [0.5])["id", 0.5] == float(start + 10_000)
    counted = {r.position_bucket: r["count"] for r in numeric.position_buckets(df, "id").groupBy("position_bucket").count().collect()}
    by_row = spark.range(20_001).select(F.col("id").cast("double").alias("id"))
    expected = {r.position_bucket: r["count"] for r in numeric.position_buckets(by_row, "id").groupBy("position_bucket").count().collect()}
    assert counted == expected
    assert {r.position_bucket: r["count"] for r in numeric.position_buckets(df, "d").groupBy("position_bucket").count().collect()} == expected
    times = by_row.select(F.expr("timestamp_micros(1700000000000000 + cast(id as bigint))").alias("t"))
    assert {r.position_bucket: r["count"] for r in numeric.position_buckets(times, "t").groupBy("position_bucket").count().collect()} == expected
