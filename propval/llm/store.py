"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from propval.session import ensure_checkpoint_dir


def _new_path(spark: SparkSession) -> str:
    """A path for a table, which goes when the application does."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def _write(df: DataFrame, path: str) -> None:
    """Adds df to the table; the shuffle files of the write are released when it ends."""
    spark: SparkSession = df.sparkSession
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean)
    spark.conf.set(clean, "true")
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(clean, before)


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage: a lost executor costs no earlier work.
    """
    path = _new_path(df.sparkSession)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(spark: SparkSession, frames: Iterable[DataFrame], schema: str) -> DataFrame:
    """The rows of all frames, each written to one table before the next is made."""
    path = _new_path(spark)
    _write(spark.createDataFrame([], schema), path)
    for df in frames:
        _write(df.select(*spark.createDataFrame([], schema).columns), path)
    return spark.read.schema(schema).parquet(path)
