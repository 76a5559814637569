"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import cotraining, decontaminate, neardup, toxicity
from spendlens.llm.common import stored, table
from spendlens.llm.queries import held_out, piece_digests

#: No SQL: learnt classifiers and the tokenizer are not expressible; the tests hold each stage against brute force.
ORACLE_SQL = None


def _new(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not use."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model, score = cotraining.learn_quality(docs, table(spark, sf_dir, "labels")), _new(docs, "quality_score")
    return cotraining.with_quality(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts; it learns from the rows that are not held out."""
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    score = _new(docs, "toxicity_score")
    return toxicity.with_toxicity(docs, model, score).where(F.col(score) < 0.5).drop(score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the decoded text."""
    return piece_digests(docs)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark),
    ("tokens", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
