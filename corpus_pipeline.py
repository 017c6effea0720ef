"""From raw documents to token files: quality, near-duplicates, benchmark
passages, mixing, tokens. Each stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairdraw.llm import decontaminate, minhash, mixing, quality, tokens
from fairdraw.llm.queries import DOMAIN, END_ID, MIX, TOKENIZER, load
from fairdraw.llm.storage import new_folder, written

# What the stages before keep is read once at most.
PIPELINE_MIX = mixing.Mix(DOMAIN, MIX.weights, budget_permille=900, max_epochs=1, seed=MIX.seed)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, load(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, PIPELINE_MIX).drop("copies")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(docs, TOKENIZER, END_ID)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("tokens", token_files),
]

# The fitted model, the similarity search and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote."""
    folder = new_folder(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
