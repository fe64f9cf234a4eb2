"""Training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and reread as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import exact_dedup, mixing, packing, quality, simhash
from lakeward.llm.base import documents, save


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    return simhash.drop_near(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("exact_duplicates", exact_duplicates),
          ("near_duplicates", near_duplicates), ("source_mixing", source_mixing),
          ("best_fit_packing", best_fit_packing)]

#: Packing is a local search, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
