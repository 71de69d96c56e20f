"""File sources and sinks (CSV / Parquet) and result folders.

Output folders live under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), never on a machine-local temporary path.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from propval.session import ensure_checkpoint_dir


def output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's outputs under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/propval-out/{name}-{uuid.uuid4().hex[:12]}"


def folder_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path below the shared folder, and the path there."""
    return fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; an explicit schema avoids the inference pass.  Names
    are lower-cased like the reference loaders."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.toDF(*[c.lower() for c in df.columns])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder, for several passes over it; the
    shuffle files of the write go when it ends."""
    spark, path = df.sparkSession, output_dir(df.sparkSession, name)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean)
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None, path: str | None = None) -> DataFrame:
    """CTAS: df as a table of the session's catalog, bucketed and sorted by
    ``keys`` (its files under ``path``, or the shared folder), and its reader.

    A join or grouping on the keys reads the table's buckets as partitions,
    so its side needs no exchange; the other side is shuffled to as many
    partitions.  Rows are dealt to their bucket before the write, so a bucket
    is one file, which is what a sorted read needs.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").option("path", path or output_dir(spark, name))
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)
