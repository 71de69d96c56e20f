"""Schema-level operators: feature discovery, alignment, dtype narrowing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.functions.groups import DEFAULT_TOGGLES, active_groups


def feature_availability(df: DataFrame, toggles=DEFAULT_TOGGLES) -> DataFrame:
    """``(toggle, group, feature, present, n_non_null, available)`` per active feature.

    Presence is a plan-time lookup on ``df.columns``; the non-NULL counts are
    one aggregation pass over the data (all-NULL columns are not available
    for model assembly)."""
    spark = df.sparkSession
    rows = active_groups(toggles)
    present = [f for _, _, f in rows if f in df.columns]
    uniq = list(dict.fromkeys(present))
    defs = spark.createDataFrame(rows, "toggle string, group string, feature string")
    if uniq:
        counts = (df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                         F.col(f).isNotNull().cast("long").alias("nn"))
                                                for f in uniq])).alias("_kv"))
                    .groupBy(F.col("_kv.feature").alias("feature")).agg(F.sum("_kv.nn").alias("n_non_null")))
        out = defs.join(counts, "feature", "left")   # one row per known feature
    else:
        out = defs.withColumn("n_non_null", F.lit(None).cast("long"))
    return out.select("toggle", "group", "feature", F.col("n_non_null").isNotNull().alias("present"),
                      F.coalesce("n_non_null", F.lit(0)).alias("n_non_null"),
                      (F.coalesce("n_non_null", F.lit(0)) > 0).alias("available"))


def align_schema(df: DataFrame, feature_names: list[str], keep=()) -> DataFrame:
    """Select ``feature_names`` in order; missing ones become 0 (e.g. dummy topics)."""
    cols = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in feature_names]
    return df.select(*keep, *cols)


def narrow_types(df: DataFrame, exclude=()) -> DataFrame:
    """float64 -> float32; int64 -> int8 when all values are in {0, 1}, else
    int32 where they fit.

    One aggregation (min / max per integer column) decides the integer casts.
    Id columns can be excluded (int32 would overflow on large key ranges)."""
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.LongType, T.IntegerType)) and f.name not in exclude]
    dbls = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name not in exclude]
    bounds = df.agg(*[x for c in ints for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))]).first() \
        if ints else None
    new = {c: F.col(c).cast("float") for c in dbls}
    for c in ints:
        lo, hi = bounds[f"{c}__min"], bounds[f"{c}__max"]
        if lo is None or lo < -(1 << 31) or hi >= 1 << 31:
            continue                                           # int32 would overflow
        new[c] = F.col(c).cast("tinyint" if lo >= 0 and hi <= 1 else "int")
    return df.withColumns(new)
