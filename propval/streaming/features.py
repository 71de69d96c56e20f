"""Listing features and tier labels on a stream of listing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.functions import tiers
from propval.operators.features import features_listing
from propval.operators.metrics import confidence_label


def listing_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``readStream`` over Parquet listing files (schema given, no inference)."""
    return spark.readStream.schema(schema).parquet(path)


def score_features(stream: DataFrame) -> DataFrame:
    """Engineered listing features, router tier and the range label: every
    expression is row-local, so no state or watermark is needed."""
    d = features_listing(stream)
    return d.withColumns({"router_tier": tiers.router_tier(F.col("price")),
                          "price_label": confidence_label(F.col("price"))})
