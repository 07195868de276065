"""From raw documents to token files, stage by stage; each stage's result is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglathe.llm.common import stored, table
from loglathe.llm.decontaminate import drop_leaks
from loglathe.llm.mixing import mixed
from loglathe.llm.near_dedup import keep_one_of_each
from loglathe.llm.quality_lines import keep_good
from loglathe.llm.token_files import token_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id; five-word shingles, similarity 0.8."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; per document its place, number of ids and their checksum."""
    return token_table(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

# near copies are found by verified signatures and tokens by a tokenizer, which SQL doesn't have
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
