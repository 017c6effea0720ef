from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fairdraw.plans.quota import Quota, allocate


def sizes(spark, *counts):
    return spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(counts)], "s string, pop_n bigint")


def taken(spark, quota, *counts):
    rows = allocate(sizes(spark, *counts), quota).orderBy("s").collect()
    return [r.n_take for r in rows], rows


def test_rounding_is_half_to_even(spark):
    assert taken(spark, Quota(pct=0.1), 5, 15, 25, 35)[0] == [0, 2, 2, 4]


def test_floor_lifts_small_strata(spark):
    take, rows = taken(spark, Quota(pct=0.1, min_rows=1), 5, 15, 25, 35, 1)
    assert take == [1, 2, 2, 4, 1]
    assert [r.is_floored for r in rows] == [True, False, False, False, True]


def test_single_row_strata(spark):
    assert taken(spark, Quota(pct=0.1, min_rows=1), *[1] * 10)[0] == [1] * 10
    assert taken(spark, Quota(pct=0.1), *[1] * 10)[0] == [0] * 10


def test_floor_and_fixed_number_stop_at_the_stratum_size(spark):
    take, rows = taken(spark, Quota(n=3), 2, 5)
    assert take == [2, 3] and [r.is_capped for r in rows] == [True, False]
    assert taken(spark, Quota(pct=0.5, min_rows=3), 1)[0] == [1]


def test_boost_and_drop(spark):
    assert taken(spark, Quota(pct=0.1, boost_below=20), 19, 20)[0] == [19, 2]
    assert taken(spark, Quota(pct=0.1, boost_levels={"s": ["s1"]}), 30, 30)[0] == [3, 30]
    assert taken(spark, Quota(pct=0.1, min_rows=1, drop_below=10), 9, 10)[0] == [0, 1]


def test_total_is_spread_in_proportion(spark):
    assert taken(spark, Quota(total=10), 30, 70)[0] == [3, 7]


def test_rounded_share_of_a_tiny_total_is_nothing(spark):
    big = 100_000
    assert taken(spark, Quota(total=4, total_digits=4), big)[0] == [0]
    assert taken(spark, Quota(total=4), big)[0] == [4]


def test_no_rows_no_strata(spark):
    assert allocate(sizes(spark).where("false"), Quota(pct=0.1)).count() == 0


@pytest.mark.parametrize(
    "arguments",
    [
        {},
        {"pct": 0.1, "n": 3},
        {"pct": 0},
        {"pct": 1},
        {"pct": 1.5},
        {"n": 0},
        {"total": 0},
        {"pct": 0.1, "min_rows": -1},
    ],
)
def test_bad_arguments_fail_before_any_job(arguments):
    with pytest.raises(ValueError):
        Quota(**arguments)


def test_level_with_quote(spark):
    df = spark.createDataFrame([("o'hara", 10)], "s string, pop_n bigint")
    quota = Quota(pct=0.1, boost_levels={"s": ["o'hara"]})
    assert allocate(df, quota).select(F.max("n_take")).collect()[0][0] == 10


def test_a_total_is_met(spark):
    for counts, total in (([3, 4, 3] * 100, 100), ([1] * 50, 7), ([10, 20, 30], 60), ([10, 20, 30], 600), ([7, 7, 7], 10)):
        take, _ = taken(spark, Quota(total=total), *counts)
        assert sum(take) == min(total, sum(counts))
        exact = [total * n / sum(counts) for n in counts]
        assert all(t in (n, int(e), int(e) + 1) for t, n, e in zip(sorted(take), sorted(counts), sorted(exact)))
    assert taken(spark, Quota(total=10), 7, 7, 7)[0] == [4, 3, 3]
    assert taken(spark, Quota(total=5), *[])[0] == []


def test_a_total_of_many_equal_remainders_goes_to_the_first(spark):
    take, _ = taken(spark, Quota(total=4), 1, 1, 1, 1, 1, 1)
    assert take == [1, 1, 1, 1, 0, 0]


def bounded(counts, total, low, high):
    """Brute force: the share by bisection over exact fractions, then the largest
    remainders of the strata between their bounds."""
    ends = sorted({Fraction(x, n) for n, lo, hi in zip(counts, low, high) for x in (lo, hi)} | {Fraction(0), Fraction(1)})
    given = [sum(min(max(s * n, lo), hi) for n, lo, hi in zip(counts, low, high)) for s in ends]
    at = max(i for i, g in enumerate(given) if g <= total)
    share = ends[at]
    if given[at] < total:
        inner = (ends[at] + ends[at + 1]) / 2
        free = [i for i, n in enumerate(counts) if low[i] < inner * n < high[i]]
        fixed = sum(lo if lo >= inner * n else hi for n, lo, hi in zip(counts, low, high) if not lo < inner * n < hi)
        share = Fraction(total - fixed, sum(counts[i] for i in free))
    exact = [min(max(share * n, lo), hi) for n, lo, hi in zip(counts, low, high)]
    take = [int(e) for e in exact]
    names = [f"s{i}" for i in range(len(counts))]
    for i in sorted(range(len(counts)), key=lambda i: (-(exact[i] - take[i]), names[i]))[: total - sum(take)]:
        take[i] += 1
    return {n: t for n, t in zip(names, take)}


@pytest.mark.parametrize(
    ("counts", "total", "quota"),
    [
        ([1000, 500, 20, 3, 1], 100, {"min_rows": 5}),
        ([1000, 500, 20, 3, 1], 100, {"min_rows": 5, "max_rows": 60}),
        ([1000, 500, 20, 3, 1], 24, {"boost_below": 10, "min_rows": 1}),
        ([1000, 500, 20, 3, 1], 300, {"max_rows": 100}),
        ([1000, 500, 20, 3, 1], 400, {"drop_below": 10, "boost_levels": {"s": ["s2"]}}),
        ([1] * 300, 300, {"min_rows": 1}),
        ([7] * 40, 100, {"min_rows": 2}),
        ([10**12, 10**6, 5, 1], 10**9, {"min_rows": 3, "max_rows": 10**9 - 10}),
        ([i * i + 1 for i in range(60)], 5000, {"min_rows": 30, "max_rows": 200}),
        ([97, 89, 83], 267, {"min_rows": 83}),
    ],
)
def test_a_total_is_met_within_bounds(spark, counts, total, quota):
    _, rows = taken(spark, Quota(total=total, **quota), *counts)
    most = [min(n, quota.get("max_rows", n)) if n >= quota.get("drop_below", 0) else 0 for n in counts]
    whole = [n < quota.get("boost_below", 0) or f"s{i}" in quota.get("boost_levels", {}).get("s", []) for i, n in enumerate(counts)]
    least = [m if w else min(m, quota.get("min_rows", 0)) for m, w in zip(most, whole)]
    assert {r.s: r.n_take for r in rows} == bounded(counts, min(total, sum(most)), least, most)
    assert sum(r.n_take for r in rows) == min(total, sum(most))


def test_a_total_below_the_least_rows_is_refused(spark):
    with pytest.raises(ValueError, match="least rows"):
        taken(spark, Quota(total=100, min_rows=1), *[5] * 300)
    assert taken(spark, Quota(total=100, min_rows=1), *[])[0] == []


def test_most_rows_of_a_stratum(spark):
    assert taken(spark, Quota(pct=0.5, max_rows=20), 10, 100)[0] == [5, 20]
    with pytest.raises(ValueError):
        Quota(pct=0.1, min_rows=5, max_rows=4)


def test_a_total_where_no_bound_binds(spark):
    counts = [1000, 990, 980, 990]
    _, rows = taken(spark, Quota(total=100, min_rows=3), *counts)
    assert {r.s: r.n_take for r in rows} == bounded(counts, 100, [3] * 4, counts)
    assert sum(r.n_take for r in rows) == 100
