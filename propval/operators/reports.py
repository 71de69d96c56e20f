"""Report tables that replace the workbook tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propval.operators.metrics import _r2


def report_summary(preds: DataFrame, n_tiers: int, n_features: int, config_name: str,
                   toggles: dict[str, bool]) -> DataFrame:
    """Executive summary as ``(metric, value_num, value_text)`` rows from one
    aggregation pass over the predictions."""
    a, p = F.col("actual"), F.col("predicted")
    row = preds.agg(F.count(F.lit(1)).cast("double").alias("total_properties"),
                    F.count_distinct("state").cast("double").alias("states_included"),
                    _r2(a, p).alias("overall_r2"), F.avg(F.abs(a - p)).alias("overall_mae"),
                    (F.avg(F.abs(F.try_divide(a - p, a))) * 100).alias("overall_mape"))
    num = [(n, F.col(n)) for n in row.columns] + [("price_tiers_trained", F.lit(float(n_tiers))),
                                                   ("total_features", F.lit(float(n_features)))]
    text = [("configuration", config_name)] + [(f"toggle_{k}", "enabled" if v else "disabled")
                                              for k, v in toggles.items()]
    items = [F.struct(F.lit(n).alias("metric"), c.cast("double").alias("value_num"),
                      F.lit(None).cast("string").alias("value_text")) for n, c in num]
    items += [F.struct(F.lit(n).alias("metric"), F.lit(None).cast("double").alias("value_num"),
                       F.lit(v).alias("value_text")) for n, v in text]
    return row.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")


def report_tiers(tier_metrics: DataFrame, filter_stats: DataFrame, tier_col: str = "price_tier") -> DataFrame:
    """Tier performance with the outlier-filter statistics where they exist."""
    fs = filter_stats.select(tier_col, "original", (F.col("original") - F.col("final")).alias("filtered"),
                             ((F.col("original") - F.col("final")) / F.col("original") * 100).alias("filter_pct"))
    return tier_metrics.join(fs, tier_col, "left")
