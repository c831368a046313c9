"""From raw documents to a training mix, in five stages; belongs to the subpackage ``tillsight.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.base import prepare, settle, table
from tillsight.llm.decontaminate import decontaminated
from tillsight.llm.line_runs import drop_frequent_lines
from tillsight.llm.mixing import mixed
from tillsight.llm.ngram_join import keep_one
from tillsight.llm.quality import keep_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws."""
    return keep_quality(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten or more of them."""
    prepare(spark)
    slim = drop_frequent_lines(docs, min_docs=10)
    return slim.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    prepare(spark)
    return keep_one(docs, width=5, num=8, den=10).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with how often it holds each."""
    prepare(spark)
    return mixed(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
]

# SQL cannot express the fitted classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each stage's output written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
