"""Loading the input tables.

Tables are read lazily; callers select the columns they need right after
``table`` so that Parquet column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events "
                 "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a lazily scanned DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
