import random

import pytest
from draws import expected_draw, priority, share
from pyspark.sql import functions as F

from fairdraw.functions.priority import hex_position
from fairdraw.operators import sampling
from fairdraw.plans import copies, selection
from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw

SCHEMA = "id bigint, a string, b int, w double"


def population(n, seed=1):
    """A third of the rows in one stratum, the rest spread unevenly, some null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = "hot" if rng.random() < 1 / 3 else rng.choice(["x", "y", None, "z z", "x | y"])
        b = 0 if a == "hot" else min(int(rng.expovariate(0.2)), 40)
        rows.append({"id": i, "a": a, "b": None if b == 7 else b, "w": rng.uniform(0.1, 10)})
    return rows


@pytest.fixture(scope="module")
def people(spark):
    rows = population(3000)
    return rows, spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).cache()


def ids_of(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize(
    "plan",
    [
        {},
        {"broadcast_keys": 1},
        {"broadcast_keys": 5},
        {"broadcast_keys": 40},
    ],
)
def test_every_route_draws_the_same_rows(people, plan):
    rows, df = people
    drawn = draw(df, ["a", "b"], Quota(pct=0.1, min_rows=1), ids=["id"], **plan)
    assert ids_of(drawn) == expected_draw(rows, ["a", "b"], ["id"], share(0.1, 1))
    assert drawn.columns == df.columns


@pytest.mark.parametrize("place", ["0.0", "0.01", "0.5", "1.0"])
def test_a_wrong_band_still_gives_the_exact_sample(people, monkeypatch, place):
    rows, df = people
    monkeypatch.setattr(selection, "_edge", lambda deviations, rows: hex_position(place))
    drawn = draw(df, ["a", "b"], Quota(pct=0.1, min_rows=1), ids=["id"])
    assert ids_of(drawn) == expected_draw(rows, ["a", "b"], ["id"], share(0.1, 1))


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_partitioning_does_not_matter(people, parts):
    rows, df = people
    drawn = draw(df.repartition(parts), ["a", "b"], Quota(pct=0.2), ids=["id"], seed=5)
    assert ids_of(drawn) == expected_draw(rows, ["a", "b"], ["id"], share(0.2), seed=5)


def test_fixed_number_on_both_routes(people):
    rows, df = people
    for n in (3, 150):
        drawn = draw(df, ["a"], Quota(n=n), ids=["id"])
        assert ids_of(drawn) == expected_draw(rows, ["a"], ["id"], lambda size, n=n: min(n, size))


def test_null_levels_are_strata_and_stay_null(people):
    _, df = people
    drawn = draw(df, ["a"], Quota(pct=0.1, min_rows=1), ids=["id"])
    assert drawn.where("a is null").count() == round(df.where("a is null").count() * 0.1)


def test_equal_display_keys_are_two_strata(spark):
    df = spark.createDataFrame([(1, "a | b", "c"), (2, "a", "b | c")], "id bigint, p string, q string")
    assert draw(df, ["p", "q"], Quota(n=1), ids=["id"]).count() == 2
    assert draw(df, ["p", "q"], Quota(pct=0.1, min_rows=1), ids=["id"]).count() == 2


def test_only_the_size_columns_and_the_prefix_are_reserved(people):
    rows, df = people
    for clash, strata, keep in (("pop_n", ["pop_n"], False), ("n_take", ["a"], True), ("_fd_cut", ["a"], False)):
        with pytest.raises(ValueError, match=clash):
            draw(df.withColumn(clash, F.lit(1)), strata, Quota(pct=0.1), ids=["id"], keep_sizes=keep)
    names = ("floor", "cut", "rank", "x", "low", "pop_n", "n_take", "before", "below", "reached")
    other = df.withColumns({c: F.lit(1) for c in names})
    drawn = draw(other.withColumn("n", F.col("a")), ["n", "rank"], Quota(pct=0.1), ids=["id", "floor"])
    assert drawn.columns == [*other.columns, "n"] and drawn.count() == draw(df, ["a"], Quota(pct=0.1), ids=["id"]).count()


def test_empty_population(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert draw(df, ["a"], Quota(pct=0.1, min_rows=1), ids=["id"]).count() == 0
    assert draw(df, ["a"], Quota(total=5), ids=["id"]).count() == 0


def test_sample_is_a_subset_without_repeats(people):
    _, df = people
    drawn = draw(df, ["a", "b"], Quota(pct=0.3, min_rows=2), ids=["id"])
    assert drawn.select("id").distinct().count() == drawn.count()
    assert drawn.exceptAll(df).count() == 0


def test_copies_without_ids(spark):
    df = spark.range(1000).select(F.expr("if(id < 700, 'hot', 'cold')").alias("k"), F.expr("id % 2").alias("v"))
    counts = {
        (r.k, r.v): r["count"]
        for r in copies.number_copies(df).drop("_fd_copy").groupBy("k", "v").count().collect()
    }
    assert counts == {("hot", 0): 350, ("hot", 1): 350, ("cold", 0): 150, ("cold", 1): 150}
    numbers = copies.number_copies(df).where("k = 'hot' and v = 0").agg(F.countDistinct("_fd_copy"), F.max("_fd_copy"))
    assert tuple(numbers.collect()[0]) == (350, 350)
    first = draw(df, ["k"], Quota(pct=0.1), seed=1).groupBy("k", "v").count()
    again = draw(df.repartition(7), ["k"], Quota(pct=0.1), seed=1).groupBy("k", "v").count()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert sum(r["count"] for r in first.collect()) == 100


@pytest.mark.parametrize("parts", [1, 7])
def test_copies_are_numbered_in_their_tasks(spark, tmp_path, parts):
    """A third of the rows are copies of one, some rows are pairs, most are alone."""
    rows = spark.range(6000).selectExpr("case when id % 3 = 0 then -1 when id % 100 = 1 then id div 200 * 200 else id end as k", "if(id % 2 = 0, null, 'x') as v")
    rows.withColumn("v", F.expr("if(k = -1, null, v)")).repartition(parts).write.parquet(f"{tmp_path}/{parts}")
    df = spark.read.parquet(f"{tmp_path}/{parts}")
    numbered = copies.number_copies(df)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and numbered.columns == [*df.columns, copies.COPY]
    assert numbered.drop(copies.COPY).exceptAll(df).count() == 0
    bounds = numbered.groupBy("k", "v").agg(F.count(copies.COPY).alias("n"), F.countDistinct(copies.COPY).alias("d"), F.max(copies.COPY).alias("m"))
    assert bounds.where("n <> d or n <> m").count() == 0
    assert bounds.agg(F.max("n")).collect()[0][0] == 2000


def test_copies_of_exchanged_and_empty_tables(spark):
    df = spark.range(300).selectExpr("id % 7 as k").groupBy("k").count().select("k").union(spark.range(3).selectExpr("id as k"))
    found = sorted((r["k"], r[copies.COPY]) for r in copies.number_copies(df).collect())
    assert found == sorted([(k, 1) for k in range(7)] + [(k, 2) for k in range(3)])
    assert copies.number_copies(spark.createDataFrame([], "k long, v array<string>")).collect() == []
    dotted = copies.number_copies(spark.createDataFrame([(1, 2), (1, 2)], "`a.b` int, `c``d` int"))
    assert dotted.columns == ["a.b", "c`d", copies.COPY] and sorted(map(tuple, dotted.collect())) == [(1, 2, 1), (1, 2, 2)]


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("keys", [20_000, 0])
def test_repeated_ids_are_refused_where_they_matter(spark, parts, keys):
    for n, ids in ((40, 1), (40, 7), (2000, 7)):
        df = spark.range(n).select((F.col("id") % ids).alias("id"), F.lit("s").alias("a")).repartition(parts)
        with pytest.raises(Exception, match="id columns"):
            draw(df, ["a"], Quota(pct=0.11), ids=["id"], broadcast_keys=keys).collect()


def test_repeated_ids_that_decide_nothing_are_drawn(spark):
    df = spark.range(40).select(F.expr("id div 2").alias("id"), F.lit("s").alias("a"))
    assert draw(df, ["a"], Quota(n=20), ids=["id"]).count() == 20
    assert draw(df, ["a"], Quota(n=50), ids=["id"]).count() == 40


def test_equal_weights_draw_like_no_weights(people):
    _, df = people
    plain = draw(df, ["a"], Quota(pct=0.1), ids=["id"])
    weighted = draw(df, ["a"], Quota(pct=0.1), ids=["id"], weight=F.lit(3))
    assert ids_of(weighted) == ids_of(plain)


def test_long_labels_are_not_broadcast_but_drawn(spark):
    rows = [{"id": i, "a": "x" * 2000 if i % 3 else "short"} for i in range(600)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id bigint, a string")
    for plan in ({}, {"broadcast_keys": 1}):
        drawn = draw(df, ["a"], Quota(pct=0.1, min_rows=1), ids=["id"], **plan)
        assert ids_of(drawn) == expected_draw(rows, ["a"], ["id"], share(0.1, 1))


def test_weighted_routes_agree_and_favour_heavy_rows(people):
    _, df = people
    drawn = [draw(df, ["a"], Quota(pct=0.1), ids=["id"], weight="w", broadcast_keys=k) for k in (20_000, 3, 0)]
    assert ids_of(drawn[0]) == ids_of(drawn[1]) == ids_of(drawn[2])
    assert drawn[0].agg(F.avg("w")).collect()[0][0] > df.agg(F.avg("w")).collect()[0][0] + 1


def test_weights_that_say_nothing_come_last_in_the_plain_order(spark):
    rows = "if(id % 4 = 0, 1.0, element_at(array(0D, -1D, double('NaN'), null), cast(id % 4 + 1 as int)))"
    df = spark.range(400).select("id", F.lit("s").alias("a"), F.expr(rows).alias("w"))
    drawn = set(ids_of(draw(df, ["a"], Quota(n=150), ids=["id"], weight="w")))
    assert {i for i in range(400) if i % 4 == 0} < drawn and len(drawn) == 150
    rest = df.where("id % 4 <> 0")
    assert drawn - {i for i in range(0, 400, 4)} == set(ids_of(draw(rest, ["a"], Quota(n=50), ids=["id"])))


def test_rows_without_weight_come_last(spark):
    df = spark.range(20).select("id", F.lit("s").alias("a"), F.expr("if(id < 5, 1.0, 0.0)").alias("w"))
    drawn = draw(df, ["a"], Quota(n=5), ids=["id"], weight="w")
    assert ids_of(drawn) == [0, 1, 2, 3, 4]


def test_design_weights_add_up_to_the_population(people):
    _, df = people
    drawn = sampling.boosted_sample(df, ["a", "b"], 0.1, below=20, min_rows=1, ids=["id"])
    assert drawn.agg(F.sum("design_weight")).collect()[0][0] == pytest.approx(df.count())
    whole = drawn.where("design_weight = 1").select("sampling_weight").distinct().collect()
    assert [r[0] for r in whole] == [pytest.approx(10.0)]


def test_large_population_leaves_no_drawn_row_in_a_shuffle(people):
    """Cuts filter the scan; only narrow rows are exchanged."""
    _, df = people
    drawn = draw(df, ["a"], Quota(pct=0.1, min_rows=1), ids=["id"])
    drawn.collect()
    plan = drawn._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    top = plan[plan.index("Final Plan"):]
    scan_side = top[: top.index("BroadcastQueryStage")]
    assert "Exchange" not in scan_side and "Window" not in scan_side


def test_small_strata_are_dropped_by_either_lookup(people):
    rows, df = people
    sizes = {}
    for r in rows:
        sizes[(r["a"], r["b"])] = sizes.get((r["a"], r["b"]), 0) + 1
    expected = sorted(r["id"] for r in rows if sizes[(r["a"], r["b"])] >= 10)
    for limit in (20_000, 3):
        assert ids_of(sampling.drop_small_strata(df, ["a", "b"], 10, broadcast_keys=limit)) == expected


def test_native_sample_takes_rows_by_their_own_priority(people):
    rows, df = people
    drawn = sampling.native_sample(df, "a", 0.1, shares={None: 0.5, "hot": 0}, ids=["id"])
    limits = {None: 0.5, "hot": 0.0}
    expected = [r["id"] for r in rows if int(priority(42, r["id"])[:13], 16) < int(limits.get(r["a"], 0.1) * 16**13)]
    assert ids_of(drawn) == sorted(expected) and drawn.where("a is null").count() > 100
    assert sampling.native_sample(df, "a", 1, ids=["id"]).count() == len(rows)
    assert 200 < sampling.native_sample(df.select("a", "b"), "a", 0.1).count() < 420
    with pytest.raises(ValueError):
        sampling.native_sample(df, "a", 1.5)


def test_random_order_sample_has_the_exact_sizes(people):
    rows, df = people
    drawn = sampling.random_order_sample(df, ["a", "b"], 0.1)
    assert drawn.count() == len(expected_draw(rows, ["a", "b"], ["id"], share(0.1, 1)))
    assert drawn.columns == df.columns


@pytest.mark.parametrize(("keys", "whole"), [(20_000, 10**6), (20_000, 0), (5, 0), (0, 0)])
@pytest.mark.parametrize("n", [1, 3, 40])
def test_first_rows_by_every_route(people, monkeypatch, n, keys, whole):
    rows, df = people
    monkeypatch.setattr(selection, "_FEW_WHOLE", whole)
    drawn = draw(df, ["a", "b"], Quota(n=n), ids=["id"], broadcast_keys=keys)
    assert ids_of(drawn) == expected_draw(rows, ["a", "b"], ["id"], lambda size: min(n, size))
    floor = draw(df, ["a", "b"], Quota(n=n, min_rows=7), ids=["id"], broadcast_keys=keys)
    assert ids_of(floor) == expected_draw(rows, ["a", "b"], ["id"], lambda size: min(max(n, 7), size))


def test_first_rows_are_limited_before_the_shuffle(people):
    _, df = people
    narrow = df.select(F.col("a").alias("_fd_k1"), F.col("b").alias("_fd_k2"), F.struct("id", "w").alias("_fd_place"))
    cuts = selection._limited(narrow, 3)
    lines = cuts._jdf.queryExecution().executedPlan().toString().splitlines()
    at = {word: [i for i, line in enumerate(lines) if word in line] for word in ("WindowGroupLimit", "Exchange")}
    # The plan is printed from its end to its start.
    assert len(at["Exchange"]) == 1 and at["WindowGroupLimit"][0] < at["Exchange"][0] < at["WindowGroupLimit"][-1]


def test_first_rows_do_not_measure_the_strata(people, monkeypatch):
    _, df = people
    monkeypatch.setattr(selection, "stratum_sizes", None)
    assert draw(df, ["a"], Quota(n=3), ids=["id"]).count() == 18


def test_first_rows_with_repeated_ids(spark):
    df = spark.range(40).select(F.expr("id div 2").alias("id"), F.lit("s").alias("a"))
    with pytest.raises(Exception, match="id columns"):
        draw(df, ["a"], Quota(n=3), ids=["id"]).collect()
    assert draw(df, ["a"], Quota(n=4), ids=["id"]).count() == 4


def test_tiny_and_huge_weights(spark):
    weight = "element_at(array(1e-320, 1e-310, 1e300, 1.0), cast(id % 4 + 1 as int))"
    df = spark.range(400).select("id", F.lit("s").alias("a"), F.expr(f"cast({weight} as double)").alias("w"))
    for quota in (Quota(n=150), Quota(pct=0.4), Quota(n=150, drop_below=2)):
        drawn = ids_of(draw(df, ["a"], quota, ids=["id"], weight="w"))
        assert len(drawn) in (150, 160) and {i for i in range(400) if i % 4 == 2} < set(drawn)


@pytest.mark.parametrize("weight", [None, "w"])
def test_large_strata_are_never_ranked_whole(people, monkeypatch, weight):
    rows, df = people
    expected = ids_of(draw(df, ["a", "b"], Quota(pct=0.1), ids=["id"], weight=weight))
    largest, in_groups_of = [], selection.in_groups_of
    monkeypatch.setattr(selection, "LARGE_ROWS", 50)
    monkeypatch.setattr(
        selection, "in_groups_of", lambda narrow, tail: largest.append(tail.agg(F.max("_fd_pop")).first()[0]) or in_groups_of(narrow, tail)
    )
    drawn = draw(df, ["a", "b"], Quota(pct=0.1), ids=["id"], weight=weight, broadcast_keys=1)
    assert ids_of(drawn) == expected and 10 < largest[0] <= 50
