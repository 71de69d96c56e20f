"""The corpus pipeline: a list of stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's docs.  All but the
last return the columns of documents.

1. quality rules: documents that the rules reject go;
2. n-gram Jaccard join: of each group of near copies the document with the
   smallest doc_id stays;
3. suffix-array dedup: 100-byte strings that start earlier are cut from the
   texts; documents that keep no word go;
4. benchmark decontamination: documents that contain an item go;
5. mixing sources to target weights: documents that the mix takes words of,
   with the words it takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propval.llm import decontaminate, jaccard, mixing, quality, suffixes
from propval.llm.store import written
from propval.session import workers_import


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return quality.kept_rows(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
]

#: Rolling hashes, recursive joins and apportionment are not SQL expressible;
#: tests/llm/test_pipeline.py holds every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it."""
    workers_import(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
