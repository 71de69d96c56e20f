"""Model artefacts: Spark ML persistence plus a metadata document.

Replaces pickled model bundles: the fitted ``PipelineModel`` is written with
``write().overwrite().save`` and the metadata (feature names, label sets,
medians, leaky-column list, metrics) is a one-row JSON dataset next to it.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_artifact(spark: SparkSession, path: str, model: PipelineModel, metadata: dict) -> str:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "metadata string") \
         .coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def load_artifact(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return model, meta
