"""A training corpus from raw documents: each stage is one operator over all that the stage before kept.

Every stage function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairforge.functions.scratch import stage
from pairforge.llm.shipping import ship_package
from pairforge.llm import best_fit_packing, co_training, jaccard_join, poisson_mixing, quality_rules


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_package(spark)
    return quality_rules.keep_by_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps.

    It is fitted on the raw documents, as the rules leave few of the labelled bad ones.
    """
    ship_package(spark)
    raw, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return co_training.keep_by_quality(docs, labels, fit_on=raw)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return jaccard_join.keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a random order."""
    return poisson_mixing.mix_sources(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of the permitted lengths."""
    ship_package(spark)
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

#: Two stages fit models, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
