"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import expected_sql
from fairdraw.functions.columns import columns_of_type, columns_with_prefix, only_if, report_round
from fairdraw.operators import chunks, collapse, drift, merge, numeric, periods, positions, profile, sampling
from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw
from fairdraw.sources import tables
from fairdraw.sources.scratch import ensure_checkpoint_dir
from fairdraw.streaming import micro_batches

SEED = 42
DOC_STRATA = ["lang", "source"]
ORDER_STRATA = ["o_orderstatus", "o_orderpriority"]
CUSTOMER_STRATA = ["c_mktsegment", "c_nationkey"]
PART_STRATA = ["p_brand", "p_type", "p_size"]
LINE_STRATA = ["l_returnflag", "l_linestatus"]
LINE_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return tables.read_parquet(spark, f"{folder}/{table}.parquet")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# --- populations -----------------------------------------------------------


def documents(spark, d):
    return load(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


def orders(spark, d):
    return load(spark, d, "orders")


def orders_with_nulls(spark, d):
    return orders(spark, d).withColumn(
        "priority", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')")
    )


def floor_documents(spark, d):
    return sampling.floor_sample(documents(spark, d), DOC_STRATA, 0.1, ids=["doc_id"], seed=SEED)


def merged_documents(spark, d):
    return merge.merge_rare_levels(documents(spark, d), "lang", "Other", threshold=0.14)


def merged_sample(spark, d):
    return sampling.floor_sample(merged_documents(spark, d), DOC_STRATA, 0.1, ids=["doc_id"], seed=SEED)


# --- queries ---------------------------------------------------------------


def floor_sample(spark, d):
    return floor_documents(spark, d).select("doc_id", "lang", "source")


def floor_sample_of_three(spark, d):
    drawn = sampling.floor_sample(documents(spark, d), DOC_STRATA, 0.1, 3, ids=["doc_id"], seed=7)
    return drawn.select("doc_id", "lang", "source")


def floor_sample_many_strata(spark, d):
    drawn = sampling.floor_sample(load(spark, d, "part"), PART_STRATA, 0.1, ids=["p_partkey"], seed=SEED)
    return drawn.select("p_partkey", *PART_STRATA)


def floor_sample_few_strata(spark, d):
    drawn = sampling.floor_sample(load(spark, d, "lineitem"), LINE_STRATA, 0.1, ids=LINE_IDS, seed=SEED)
    return drawn.select(*LINE_IDS, "l_extendedprice", *LINE_STRATA)


def floor_sample_by_cut(spark, d):
    drawn = sampling.floor_sample(
        load(spark, d, "lineitem"), LINE_STRATA, 0.1, ids=LINE_IDS, seed=SEED, broadcast_keys=3
    )
    return drawn.select(*LINE_IDS, "l_extendedprice", *LINE_STRATA)


def floor_sample_mixed_sizes(spark, d):
    drawn = sampling.floor_sample(
        documents(spark, d), DOC_STRATA, 0.1, ids=["doc_id"], seed=SEED, broadcast_keys=30
    )
    return drawn.select("doc_id", "lang", "source")


def proportional_sample(spark, d):
    drawn = sampling.proportional_sample(orders(spark, d), ORDER_STRATA, 0.1, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", *ORDER_STRATA)


def proportional_sample_vanishing(spark, d):
    drawn = sampling.proportional_sample(documents(spark, d), DOC_STRATA, 0.1, ids=["doc_id"], seed=SEED)
    return drawn.select("doc_id", "lang", "source")


def fixed_n_sample(spark, d):
    drawn = sampling.fixed_sample(load(spark, d, "customer"), CUSTOMER_STRATA, 3, ids=["c_custkey"], seed=SEED)
    return drawn.select("c_custkey", *CUSTOMER_STRATA)


def fixed_n_takes_small_strata_whole(spark, d):
    drawn = sampling.fixed_sample(load(spark, d, "part"), PART_STRATA, 3, ids=["p_partkey"], seed=SEED)
    return drawn.select("p_partkey", *PART_STRATA)


def fixed_n_large(spark, d):
    drawn = sampling.fixed_sample(orders(spark, d), ORDER_STRATA, 250, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", *ORDER_STRATA)


def null_strata_sample(spark, d):
    strata = ["o_orderstatus", "priority"]
    drawn = sampling.floor_sample(orders_with_nulls(spark, d), strata, 0.1, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", *strata)


def sample_without_ids(spark, d):
    rows = load(spark, d, "labels").select("quality", "toxic")
    return sampling.floor_sample(rows, ["quality"], 0.2, seed=SEED)


def sample_of_copies(spark, d):
    rows = load(spark, d, "events").select("event_type", "user_id")
    return sampling.floor_sample(rows, ["event_type"], 0.1, seed=SEED)


def drop_small_strata(spark, d):
    kept = sampling.drop_small_strata(documents(spark, d), DOC_STRATA, 10)
    return kept.select("doc_id", "lang", "source")


def sample_without_small_strata(spark, d):
    quota = Quota(pct=0.1, min_rows=1, drop_below=10)
    return draw(documents(spark, d), DOC_STRATA, quota, ids=["doc_id"], seed=SEED).select("doc_id", "lang", "source")


def boost_small_strata(spark, d):
    drawn = sampling.boosted_sample(documents(spark, d), DOC_STRATA, 0.1, below=20, min_rows=1, ids=["doc_id"], seed=SEED)
    return drawn.select("doc_id", "lang", "source", "sampling_weight", "design_weight")


def boost_levels(spark, d):
    drawn = sampling.boosted_sample(
        documents(spark, d), DOC_STRATA, 0.1, levels={"lang": ["es"]}, min_rows=1, ids=["doc_id"], seed=SEED
    )
    return drawn.select("doc_id", "lang", "source", "sampling_weight", "design_weight")


def design_weight_total(spark, d):
    drawn = sampling.boosted_sample(documents(spark, d), DOC_STRATA, 0.1, below=20, min_rows=1, ids=["doc_id"], seed=SEED)
    return drawn.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.expr("cast(rint(sum(design_weight)) as bigint)").alias("stands_for")
    )


def total_size_sample(spark, d):
    drawn = sampling.total_sample(orders(spark, d), ORDER_STRATA, 500, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", *ORDER_STRATA)


def total_size_rounded_share(spark, d):
    drawn = sampling.total_sample(orders(spark, d), ORDER_STRATA, 500, total_digits=4, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", *ORDER_STRATA)


def weighted_sample(spark, d):
    drawn = sampling.weighted_sample(orders(spark, d), ["o_orderpriority"], "o_totalprice", pct=0.1, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", "o_orderpriority")


def weighted_sample_by_cut(spark, d):
    drawn = sampling.weighted_sample(
        orders(spark, d), ["o_orderpriority"], "o_totalprice", pct=0.1, ids=["o_orderkey"], seed=SEED, broadcast_keys=2
    )
    return drawn.select("o_orderkey", "o_orderpriority")


def native_sample(spark, d):
    drawn = sampling.native_sample(orders(spark, d), "o_orderstatus", 0.1, ids=["o_orderkey"], seed=SEED)
    return drawn.select("o_orderkey", "o_orderstatus")


def native_sample_null_levels(spark, d):
    shares = {None: 0.5, "1-URGENT": 0.25}
    drawn = sampling.native_sample(
        orders_with_nulls(spark, d), "priority", 0.05, shares=shares, ids=["o_orderkey"], seed=SEED
    )
    return drawn.select("o_orderkey", "priority")


def total_size_many_strata(spark, d):
    drawn = sampling.total_sample(load(spark, d, "part"), PART_STRATA, 100, ids=["p_partkey"], seed=SEED)
    return drawn.select("p_partkey", *PART_STRATA)


def weighted_fixed_n(spark, d):
    drawn = sampling.weighted_sample(
        load(spark, d, "lineitem"), LINE_STRATA, "l_quantity", n=100, ids=LINE_IDS, seed=SEED
    )
    return drawn.select(*LINE_IDS, *LINE_STRATA)


def drift_after_merge(spark, d):
    report = drift.drift_three_tier(merged_documents(spark, d), merged_sample(spark, d), DOC_STRATA)
    return report


def merge_levels_many(spark, d):
    return merge.level_table(load(spark, d, "part"), "p_type", "Other", threshold=None, min_count=14)


def values_with_nan(spark, d):
    rows = load(spark, d, "events").select("event_id", "event_type", "value")
    return rows.withColumn("value", F.expr("if(event_type = 'error', double('NaN'), value)")).drop("event_type")


def deciles_with_nan(spark, d):
    return numeric.deciles(values_with_nan(spark, d), ["value"])


def summary_with_nan(spark, d):
    table = numeric.numeric_summary(values_with_nan(spark, d), ["value"])
    return table.select(
        "column", "n", *[report_round(F.col(c), 3).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")]
    )


def null_counts_with_nan(spark, d):
    return numeric.null_counts(values_with_nan(spark, d))


def large_keys(spark, d):
    return orders(spark, d).select(F.expr(f"o_orderkey + {2**60}L").alias("key"))


def position_buckets_large_keys(spark, d):
    return numeric.position_buckets(large_keys(spark, d), "key")


def random_order_sample(spark, d):
    drawn = sampling.random_order_sample(
        documents(spark, d), DOC_STRATA, 0.1, depth=1, root=f"{d}/documents.parquet", seed=SEED
    )
    return drawn.select("doc_id", "lang", "source")


def total_size_with_floor(spark, d):
    drawn = sampling.total_sample(
        load(spark, d, "customer"), CUSTOMER_STRATA, 400, min_rows=3, ids=["c_custkey"], seed=SEED
    )
    return drawn.select("c_custkey", *CUSTOMER_STRATA)


def total_size_with_boosts(spark, d):
    rows = documents(spark, d)
    quota = Quota(total=rows.count() // 2, min_rows=1, max_rows=60, boost_levels={"lang": ["es"]}, drop_below=3)
    return draw(rows, DOC_STRATA, quota, ids=["doc_id"], seed=SEED).select("doc_id", *DOC_STRATA)


def small_strata_collapsed(spark, d):
    rows = load(spark, d, "part").select("p_partkey", *PART_STRATA)
    return collapse.collapse_small_strata(rows, PART_STRATA, 4)


def small_strata_collapsed_by_shuffle(spark, d):
    rows = documents(spark, d).select("doc_id", *DOC_STRATA)
    return collapse.collapse_small_strata(rows, DOC_STRATA, 9, broadcast_keys=10)


def conditional_nulls(spark, d):
    finished = F.col("o_orderstatus") == "F"
    rows = orders(spark, d).withColumn("finished_priority", only_if(finished, F.col("o_orderpriority")))
    return profile.level_shares(rows, ["finished_priority"])


def strata_sizes(spark, d):
    return profile.strata_sizes(orders_with_nulls(spark, d), ["o_orderstatus", "priority"])


def strata_count(spark, d):
    return profile.strata_count(load(spark, d, "part"), PART_STRATA)


def strata_profile(spark, d):
    return profile.strata_profile(documents(spark, d), DOC_STRATA)


def allocation_table(spark, d):
    return profile.allocation_table(documents(spark, d), DOC_STRATA, Quota(pct=0.1, min_rows=2))


def floor_report(spark, d):
    return profile.floor_cap_report(documents(spark, d), DOC_STRATA, Quota(pct=0.1, min_rows=1))


def cap_report(spark, d):
    return profile.floor_cap_report(load(spark, d, "part"), PART_STRATA, Quota(n=3))


def vanished_strata(spark, d):
    return profile.vanished_strata(documents(spark, d), DOC_STRATA, 0.1)


def level_shares(spark, d):
    return profile.level_shares(orders_with_nulls(spark, d), ["o_orderstatus", "priority"])


def sample_rate(spark, d):
    return profile.sample_rate(documents(spark, d), floor_documents(spark, d))


def drift_raw(spark, d):
    return drift.drift_raw(documents(spark, d), floor_documents(spark, d), DOC_STRATA)


def drift_two_tier(spark, d):
    return drift.drift_two_tier(documents(spark, d), floor_documents(spark, d), DOC_STRATA)


def drift_three_tier(spark, d):
    return drift.drift_three_tier(documents(spark, d), floor_documents(spark, d), DOC_STRATA)


def drift_lost_levels(spark, d):
    """The English documents stand for all: most levels drift, some are lost."""
    some = documents(spark, d).where("lang = 'en'")
    return drift.drift_three_tier(documents(spark, d), some, DOC_STRATA)


def drift_weighted(spark, d):
    drawn = sampling.boosted_sample(documents(spark, d), DOC_STRATA, 0.1, below=20, min_rows=1, ids=["doc_id"], seed=SEED)
    report = drift.drift_three_tier(documents(spark, d), drawn, DOC_STRATA, weight="design_weight")
    # Sums of fractional weights depend on their order in the last bits.
    return report.withColumn("samp_pct", report_round(F.col("samp_pct"), 9))


def drift_flagged(spark, d):
    marked = load(spark, d, "events").withColumn("late", F.col("value") > 50)
    return drift.compare_flagged(marked, F.col("late"), ["event_type"]).select(
        "column", "level", "pop_n", "samp_n", "pop_pct", "samp_pct", "abs_diff"
    )


def drift_summary(spark, d):
    return drift.drift_summary(drift_two_tier(spark, d))


def drift_summary_strict(spark, d):
    return drift.drift_summary(drift_lost_levels(spark, d), max_drift_pct=2.0)


def drift_summary_with_floors(spark, d):
    return drift.drift_summary(drift_two_tier(spark, d), allocation=allocation_table(spark, d))


def level_representation(spark, d):
    return drift.level_representation(documents(spark, d), floor_documents(spark, d), "lang", ["es", "fr", "xx"])


def merge_rare_share(spark, d):
    return merged_documents(spark, d).select("doc_id", "lang", "lang_original")


def merge_rare_count(spark, d):
    customers = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    return merge.merge_rare_levels(customers, "c_nationkey", "Other", threshold=None, min_count=60)


def merge_rare_count_many_levels(spark, d):
    parts = load(spark, d, "part").select("p_partkey", "p_type")
    return merge.merge_rare_levels(parts, "p_type", "Other", threshold=None, min_count=12, broadcast_keys=5)


def merge_nulls(spark, d):
    rows = orders_with_nulls(spark, d).select("o_orderkey", "priority")
    return merge.merge_rare_levels(rows, "priority", "Other", threshold=0.2, merge_nulls=True)


def merge_level_table(spark, d):
    return merge.level_table(documents(spark, d), "lang", "Other", threshold=0.14)


def merge_report(spark, d):
    return merge.merge_report(documents(spark, d), "lang", "Other", threshold=0.14)


def strata_before_after(spark, d):
    return merge.strata_before_after(merged_documents(spark, d), DOC_STRATA, "lang")


def sample_after_merge(spark, d):
    return merged_sample(spark, d).select("doc_id", "lang", "lang_original", "source")


def merge_audit(spark, d):
    return merge.merge_audit(merged_sample(spark, d), "lang", "Other")


def coerced_numbers(spark, d):
    rows = load(spark, d, "events").select(
        "event_id", F.expr("if(event_type = 'error', 'n/a', cast(user_id as string))").alias("amount")
    )
    return numeric.coerce_numbers(rows, ["amount"])


def winsorized(spark, d):
    rows = load(spark, d, "events").select("event_id", "value")
    return numeric.winsorize(rows, ["value"]).withColumn("value", report_round(F.col("value"), 4))


def tail_quantiles(spark, d):
    table = numeric.quantiles(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], [0.99])
    return table.withColumn("value", report_round(F.col("value"), 4))


def deciles(spark, d):
    return numeric.deciles(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])


def deciles_winsorized(spark, d):
    return numeric.deciles(load(spark, d, "events"), ["value"], clip_at=0.99)


def decile_buckets(spark, d):
    return numeric.decile_buckets(load(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


def decile_cells(spark, d):
    rows = load(spark, d, "lineitem").select(*LINE_IDS, "l_quantity", "l_extendedprice")
    return sampling.decile_cell_sample(rows, ["l_quantity", "l_extendedprice"], 0.05, ids=LINE_IDS, seed=SEED).select(
        *LINE_IDS, "bucket_l_quantity", "bucket_l_extendedprice"
    )


def bucket_columns(spark, d):
    rows = load(spark, d, "lineitem").select("l_quantity", "l_tax")
    bucketed = numeric.decile_buckets(rows, ["l_quantity", "l_tax"])
    cells = columns_with_prefix(bucketed, numeric.BUCKET_PREFIX)
    return bucketed.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))


def position_buckets(spark, d):
    bucketed = numeric.position_buckets(orders(spark, d), "o_orderkey")
    return bucketed.select("o_orderkey", "position_bucket")


def position_sample(spark, d):
    drawn = sampling.position_sample(
        orders(spark, d), "o_orderkey", 500, ids=["o_orderkey"], numeric=["o_totalprice"], seed=SEED
    )
    return drawn.select("o_orderkey", "o_orderstatus", report_round(F.col("o_totalprice"), 2).alias("o_totalprice"))


def row_positions(spark, d):
    return positions.row_position(orders(spark, d).select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


def numeric_summary(spark, d):
    table = numeric.numeric_summary(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return table.select(
        "column", "n", *[report_round(F.col(c), 3).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")]
    )


def numeric_before_after(spark, d):
    table = numeric.numeric_before_after(
        orders(spark, d), proportional_orders(spark, d), ["o_totalprice"]
    )
    return table.select(
        "column", "measure", *[report_round(F.col(c), 2).alias(c) for c in ("population", "sample")]
    )


def proportional_orders(spark, d):
    return sampling.proportional_sample(orders(spark, d), ORDER_STRATA, 0.1, ids=["o_orderkey"], seed=SEED)


def null_counts(spark, d):
    return numeric.null_counts(orders_with_nulls(spark, d))


def numeric_column_totals(spark, d):
    rows = orders(spark, d)
    return numeric.null_counts(rows, columns_of_type(rows, "numeric"))


def two_period_sample(spark, d):
    rows = load(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    half = "dayofmonth(ts) <= 15"
    drawn = periods.period_sample(
        [
            ("first", rows.where(half), ["event_type"]),
            ("second", rows.where(f"not ({half})"), ["event_type"]),
        ],
        Quota(pct=0.1),
        ["user_id"],
        ids=["event_id"],
        seed=SEED,
    )
    return drawn.select("event_id", "user_id", "event_type", "period")


def two_period_id_list(spark, d):
    return periods.id_list(two_period_sample(spark, d), ["user_id"])


def two_period_cells(spark, d):
    rows = load(spark, d, "lineitem").select(*LINE_IDS, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    bucketed = numeric.decile_buckets(numeric.coerce_numbers(rows, columns), columns, clip_at=numeric.TAIL)
    cells = [numeric.BUCKET_PREFIX + c for c in columns]
    drawn = periods.period_sample(
        [("one", bucketed, cells[:2]), ("two", bucketed, cells[2:])],
        Quota(pct=0.02),
        ["l_orderkey"],
        ids=LINE_IDS,
        seed=SEED,
    )
    return drawn.select(*LINE_IDS, "period")


def chunk_sample(spark, d):
    rows = load(spark, d, "events").select("event_id", "event_type")
    return chunks.chunk_sample(
        rows, ["event_type"], F.expr("event_id div 1000"), 0.01, 3, ids=["event_id"], seed=SEED
    )


def chunk_sample_global_floor(spark, d):
    rows = load(spark, d, "events").select("event_id", "event_type")
    return chunks.chunk_sample(
        rows, ["event_type"], F.expr("event_id div 1000"), 0.01, 3, floor_scope="global", ids=["event_id"], seed=SEED
    )


def chunk_sample_by_position(spark, d):
    rows = orders(spark, d).select("o_orderkey", "o_orderpriority")
    chunked = chunks.chunk_of_position(rows, ["o_orderkey"], 2_000, "chunk")
    return chunks.chunk_sample(
        chunked, ["o_orderpriority"], F.col("chunk"), 0.05, ids=["o_orderkey"], seed=SEED
    ).select("o_orderkey", "o_orderpriority", "chunk_id")


def chunk_sample_by_file(spark, d):
    rows = orders(spark, d).select("o_orderkey", "o_orderpriority")
    placed = positions.with_file_rows(rows, depth=1, root=f"{d}/orders.parquet")
    chunk = positions.placed_chunk(2_000)
    drawn = chunks.chunk_sample(placed, ["o_orderpriority"], chunk, 0.05, ids=["o_orderkey"], seed=SEED)
    return drawn.drop(*positions.FILE_ROW)


def weekly_events(spark, d, folder):
    """The events as a stream of weekly files, one in each micro-batch."""
    rows = load(spark, d, "events").select("event_id", "event_type", "user_id", F.weekofyear("ts").alias("week"))
    rows.repartition("week").write.partitionBy("week").parquet(f"{folder}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def stream_sample(spark, d):
    folder = scratch_folder(spark, "stream")
    stream = weekly_events(spark, d, folder).drop("user_id")
    query = micro_batches.sample_stream(
        stream, ["event_type"], 0.1, ids=["event_id"], path=f"{folder}/out", checkpoint=f"{folder}/state", seed=SEED
    )
    query.awaitTermination()
    return micro_batches.read_stream_sample(spark, f"{folder}/out", stream).drop("batch_id")


def stream_sample_global_floor(spark, d):
    folder = scratch_folder(spark, "stream")
    stream = weekly_events(spark, d, folder)
    place = {"ids": ["event_id"], "seed": SEED}
    query = micro_batches.sample_whole_stream(
        stream, ["user_id"], 0.01, 2, path=f"{folder}/out", checkpoint=f"{folder}/state", **place
    )
    query.awaitTermination()
    return micro_batches.read_whole_stream_sample(spark, f"{folder}/out", stream, 0.01, **place)


def csv_round_trip(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    folder = scratch_folder(spark, "csv")
    tables.write_csv(rows, f"{folder}/customer")
    back = tables.read_csv(spark, f"{folder}/customer", rows.schema)
    return sampling.floor_sample(back, ["c_mktsegment"], 0.1, ids=["c_custkey"], seed=SEED)


def parquet_round_trip(spark, d):
    folder = scratch_folder(spark, "parquet")
    tables.write_parquet(floor_documents(spark, d), f"{folder}/sample")
    return tables.read_parquet(spark, f"{folder}/sample")


def catalog_sample(spark, d):
    tables.register(load(spark, d, "customer"), "fairdraw_customer")
    rows = tables.read_table(spark, "fairdraw_customer")
    return sampling.floor_sample(rows, ["c_mktsegment"], 0.1, ids=["c_custkey"], seed=SEED).select("c_custkey", "c_mktsegment")


def catalog_table_sample(spark, d):
    table = f"default.fairdraw_customer_{uuid.uuid4().hex}"
    load(spark, d, "customer").write.option("path", scratch_folder(spark, "catalog")).saveAsTable(table)
    rows = tables.read_table(spark, table)
    return sampling.floor_sample(rows, ["c_mktsegment"], 0.1, ids=["c_custkey"], seed=SEED).select("c_custkey", "c_mktsegment")


def preview(spark, d):
    return tables.preview(orders(spark, d).select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"])


def entry(spark: SparkSession) -> DataFrame:
    """Floor sample of the documents by language and source."""
    return floor_sample(spark, "/root/testdata/sf0.001")


_QUERIES = (
    floor_sample, floor_sample_of_three, floor_sample_many_strata, floor_sample_few_strata,
    floor_sample_by_cut, floor_sample_mixed_sizes, proportional_sample, proportional_sample_vanishing,
    fixed_n_sample, fixed_n_takes_small_strata_whole, fixed_n_large, null_strata_sample,
    sample_without_ids, sample_of_copies, drop_small_strata, sample_without_small_strata,
    boost_small_strata, boost_levels, design_weight_total, total_size_sample, total_size_rounded_share,
    weighted_sample, weighted_sample_by_cut, weighted_fixed_n, native_sample, native_sample_null_levels,
    total_size_many_strata, total_size_with_floor, total_size_with_boosts, small_strata_collapsed,
    small_strata_collapsed_by_shuffle, conditional_nulls, random_order_sample, drift_after_merge, merge_levels_many, deciles_with_nan,
    summary_with_nan, null_counts_with_nan, position_buckets_large_keys,
    strata_sizes, strata_count, strata_profile, allocation_table, floor_report, cap_report,
    vanished_strata, level_shares, sample_rate, drift_raw, drift_two_tier, drift_three_tier,
    drift_lost_levels, drift_weighted, drift_flagged, drift_summary, drift_summary_strict, drift_summary_with_floors,
    level_representation, merge_rare_share, merge_rare_count, merge_rare_count_many_levels, merge_nulls,
    merge_level_table, merge_report, strata_before_after, sample_after_merge, merge_audit,
    coerced_numbers, winsorized, tail_quantiles, deciles, deciles_winsorized, decile_buckets,
    decile_cells, bucket_columns, position_buckets, position_sample, row_positions, numeric_summary,
    numeric_before_after, null_counts, numeric_column_totals, two_period_sample, two_period_id_list,
    two_period_cells, chunk_sample, chunk_sample_global_floor, chunk_sample_by_position, chunk_sample_by_file,
    stream_sample, stream_sample_global_floor,
    csv_round_trip, parquet_round_trip, catalog_sample, catalog_table_sample, preview,
)


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def _optional(module: str):
    """A module of the optional subpackage, or nothing where that or a library it
    needs is not installed."""
    try:
        return importlib.import_module(module)
    except ImportError:
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = own_queries()
    if operators := _optional("fairdraw.llm.queries"):
        named |= operators.QUERIES
    if pipeline := _optional("corpus_pipeline"):
        named["pipeline"] = pipeline.run
    return named


def oracle_sql() -> dict[str, str]:
    statements = expected_sql.statements()
    if operators := _optional("fairdraw.llm.queries"):
        statements |= operators.ORACLE_SQL
    if (pipeline := _optional("corpus_pipeline")) and pipeline.ORACLE_SQL:
        statements["pipeline"] = pipeline.ORACLE_SQL
    return statements
