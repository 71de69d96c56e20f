"""Error metrics, distributions and comparisons (survey 2.4, 2.6).

Every metric is one grouped aggregation; percentiles are exact (linear
interpolation as in pandas) and distributed (``functions.quantiles``), so no
group has to fit a task.  Thresholds
that drive a later filter (percentile edges, z-score moments) are one-row or
per-group aggregates joined back with a broadcast of proven size (one row
per group of a fixed, small grouping).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.functions import tiers
from propval.functions.quantiles import agg_with_quantiles, quantile_row, quantiles


def tier_distribution(df: DataFrame, price: str, tier_table=tiers.PRICE_TIERS) -> DataFrame:
    """Count, share of all rows, min and max price per tier."""
    g = (df.select(tiers.price_tier(F.col(price), tier_table).alias("price_tier"), F.col(price).alias("_p"))
           .groupBy("price_tier")
           .agg(F.count(F.lit(1)).alias("n"), F.min("_p").alias("min_price"), F.max("_p").alias("max_price")))
    # the window runs over at most len(tier_table) rows
    total = F.sum("n").over(Window.partitionBy())
    return g.select("price_tier", "n", (F.lit(100.0) * F.col("n") / total).alias("share_pct"),
                    "min_price", "max_price")


def with_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``error = actual - predicted``, ``abs_error``, ``pct_error`` (percent)."""
    err = F.col(actual) - F.col(predicted)
    return df.withColumns({"error": err, "abs_error": F.abs(err),
                           "pct_error": F.abs(F.try_divide(err, F.col(actual))) * 100})


def _r2(actual: Column, predicted: Column) -> Column:
    """``1 - SS_res / SS_tot`` with ``SS_tot = n * var_pop`` (stable); NULL
    when the actuals do not vary."""
    ss_res = F.sum(F.pow(actual - predicted, 2))
    ss_tot = F.var_pop(actual) * F.count(actual)
    return F.when(ss_tot > 0, F.lit(1.0) - ss_res / ss_tot)


def regression_aggs(actual: str = "actual", predicted: str = "predicted") -> list[Column]:
    """n, MAE, RMSE, R2, MAPE, trimmed MAPE (< 100), within 10/20/30 %."""
    a, p = F.col(actual), F.col(predicted)
    ape = F.abs(F.try_divide(a - p, a)) * 100
    within = lambda k: F.avg(F.when(ape <= k, 1.0).otherwise(0.0)) * 100
    return [F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(a - p)).alias("mae"),
            F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"),
            _r2(a, p).alias("r2"),
            F.avg(ape).alias("mape"),
            F.avg(F.when(ape < 100, ape)).alias("mape_trimmed"),
            within(10).alias("within_10"), within(20).alias("within_20"), within(30).alias("within_30")]


def regression_metrics(df: DataFrame, by: list[str] | None = None, actual: str = "actual",
                       predicted: str = "predicted") -> DataFrame:
    """:func:`regression_aggs` and the median absolute percentage error."""
    a, p = F.col(actual), F.col(predicted)
    return agg_with_quantiles(df, by or [], regression_aggs(actual, predicted), {"medape": (F.abs(F.try_divide(a - p, a)) * 100, 0.5)})


def metrics_by_range(df: DataFrame, ranges=tiers.RANGES_4) -> DataFrame:
    """MedAPE, MAE and count per left-closed ``[low, high)`` range of actual."""
    d = with_errors(df).withColumn("price_range", tiers.left_closed_range(F.col("actual"), ranges))
    return agg_with_quantiles(d.filter(F.col("price_range").isNotNull()), ["price_range"],
                              [F.avg("abs_error").alias("mae"), F.count(F.lit(1)).alias("n")], {"medape": ("pct_error", 0.5)})


def metrics_by_cut(df: DataFrame) -> DataFrame:
    """Per right-closed bin (``pd.cut``): count, median error, MedAPE, MAE, R2."""
    d = with_errors(df).withColumn("price_range", tiers.right_closed_cut(F.col("actual")))
    return agg_with_quantiles(d.filter(F.col("price_range").isNotNull()), ["price_range"],
                              [F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"), _r2(F.col("actual"), F.col("predicted")).alias("r2")],
                              {"median_error": ("error", 0.5), "medape": ("pct_error", 0.5)})


def error_intervals(df: DataFrame, min_count: int = 10) -> DataFrame:
    """p5 / p95 of % error and the interval width per bin with > min_count rows."""
    d = with_errors(df).withColumn("price_range", tiers.right_closed_cut(F.col("actual")))
    g = agg_with_quantiles(d.filter(F.col("price_range").isNotNull()), ["price_range"], [F.count(F.lit(1)).alias("n")],
                           {"lower": ("pct_error", 0.05), "upper": ("pct_error", 0.95)})
    return g.filter(F.col("n") > min_count).withColumn("width", F.col("upper") - F.col("lower"))


def interval_coverage(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Percent of actuals inside ``[pred_lower, pred_upper]``."""
    inside = F.when(F.col("actual").between(F.col("pred_lower"), F.col("pred_upper")), 1.0).otherwise(0.0)
    agg = [F.count(F.lit(1)).alias("n"), (F.avg(inside) * 100).alias("coverage_pct")]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


def feature_extremes(df: DataFrame, features: list[str], id_col: str = "property_id") -> DataFrame:
    """Rows at or below p10 / at or above p90 of each feature: count, MedAPE, MAE.

    The features are unpivoted to ``(feature, value)`` so that thresholds are
    one grouped pass (one row per feature, joined back)."""
    d = with_errors(df)
    long = d.select(id_col, "pct_error", "abs_error",
                    F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                                        for f in features])).alias("_kv")) \
            .select(id_col, "pct_error", "abs_error", "_kv.feature", "_kv.value")
    th = quantiles(long, ["feature"], {"p10": ("value", 0.1), "p90": ("value", 0.9)})
    j = long.join(th, "feature")
    side = F.explode(F.array(
        F.when(F.col("value") <= F.col("p10"), F.struct(F.lit("bottom_10").alias("side"), F.col("p10").alias("threshold"))),
        F.when(F.col("value") >= F.col("p90"), F.struct(F.lit("top_10").alias("side"), F.col("p90").alias("threshold")))))
    s = j.select("feature", "pct_error", "abs_error", side.alias("_s")).filter(F.col("_s").isNotNull())
    s = s.select("feature", "pct_error", "abs_error", "_s.side", "_s.threshold")
    return agg_with_quantiles(s, ["feature", "side", "threshold"], [F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae")],
                              {"medape": ("pct_error", 0.5)})


def decile_profile(df: DataFrame, feature: str, q: int = 10) -> DataFrame:
    """``qcut(feature, q, duplicates='drop')`` bins (right-closed, lowest
    included) with the median % error per bin.  Edges are one aggregate of
    q+1 numbers."""
    d = with_errors(df)
    edges = sorted({e for e in quantile_row(d, {f"e{i}": (feature, i / q) for i in range(q + 1)}).values() if e is not None})
    if len(edges) < 2:
        return d.sparkSession.createDataFrame([], "bin int, bin_left double, bin_right double, n bigint, medape double")
    x = F.col(feature).cast("double")
    bin_idx = reduce(lambda a, b: a + b, [F.when(x > F.lit(e), 1).otherwise(0) for e in edges[1:-1]], F.lit(0))
    lefts = F.array(*[F.lit(e) for e in edges[:-1]])
    rights = F.array(*[F.lit(e) for e in edges[1:]])
    g = agg_with_quantiles(d.filter(x.isNotNull()).withColumn("bin", bin_idx.cast("int")), ["bin"], [F.count(F.lit(1)).alias("n")],
                           {"medape": ("pct_error", 0.5)})
    return g.select("bin", F.element_at(lefts, F.col("bin") + 1).alias("bin_left"),
                    F.element_at(rights, F.col("bin") + 1).alias("bin_right"), "n", "medape")


def zscore_outliers(df: DataFrame, threshold: float = 2.0, id_col: str = "property_id") -> DataFrame:
    """Rows with ``|(error - mean) / std| > threshold`` (sample std), with a
    ``z_gt_3`` flag.  Moments are one global aggregate."""
    d = with_errors(df)
    m = d.agg(F.avg("error").alias("mu"), F.stddev_samp("error").alias("sd")).first()
    if m["sd"] is None or m["sd"] == 0:
        return d.limit(0).withColumn("z_score", F.lit(None).cast("double")).withColumn("z_gt_3", F.lit(False))
    z = F.abs((F.col("error") - F.lit(m["mu"])) / F.lit(m["sd"]))
    return (d.withColumn("z_score", z).filter(F.col("z_score") > threshold)
             .withColumn("z_gt_3", F.col("z_score") > 3)
             .select(id_col, "actual", "predicted", "error", "pct_error", "z_score", "z_gt_3"))


def extrema_summary(df: DataFrame) -> DataFrame:
    """Key/value summary: count, best/worst/p90/p95 error, outliers, within-k."""
    d = with_errors(df)
    m = d.agg(F.avg("error").alias("mu"), F.stddev_samp("error").alias("sd")).first()
    z = F.abs((F.col("error") - F.lit(m["mu"])) / F.lit(m["sd"] or 1.0))
    within = lambda k: F.avg(F.when(F.col("pct_error") <= k, 1.0).otherwise(0.0)) * 100
    row = agg_with_quantiles(d, [], [
        F.count(F.lit(1)).cast("double").alias("total_predictions"), F.min("pct_error").alias("best_error"), F.max("pct_error").alias("worst_error"),
        F.count(F.when(z > 3, 1)).cast("double").alias("outliers_z3"),
        within(10).alias("within_10"), within(20).alias("within_20"), within(30).alias("within_30")],
        {"p90_error": ("pct_error", 0.9), "p95_error": ("pct_error", 0.95)})
    names = row.columns
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                          for n in names])).alias("_kv")).select("_kv.metric", "_kv.value")


def best_worst(df: DataFrame, n: int = 10, id_col: str = "property_id") -> DataFrame:
    """``n`` smallest and ``n`` largest % errors (ties by id)."""
    d = with_errors(df).select(id_col, "actual", "predicted", "error", "pct_error")
    best = d.orderBy(F.col("pct_error").asc(), F.col(id_col)).limit(n).withColumn("section", F.lit("best"))
    worst = d.orderBy(F.col("pct_error").desc(), F.col(id_col)).limit(n).withColumn("section", F.lit("worst"))
    return best.unionByName(worst)


def over_under(df: DataFrame, n: int = 10, id_col: str = "property_id") -> DataFrame:
    """Largest over-predictions (predicted > actual) and under-predictions."""
    d = with_errors(df).select(id_col, "actual", "predicted", "error", "pct_error")
    over = d.orderBy(F.col("error").asc(), F.col(id_col)).limit(n).withColumn("section", F.lit("over"))
    under = d.orderBy(F.col("error").desc(), F.col(id_col)).limit(n).withColumn("section", F.lit("under"))
    return over.unionByName(under)


def extrema_report(df: DataFrame, n: int = 10, id_col: str = "property_id") -> DataFrame:
    """Named sections in one table: best, worst, over, under, outliers (z>3)
    and per-range aggregates."""
    rows = best_worst(df, n, id_col).unionByName(over_under(df, n, id_col))
    z = (zscore_outliers(df, 3.0, id_col).select(id_col, "actual", "predicted", "error", "pct_error")
         .withColumn("section", F.lit("outliers")))
    d = with_errors(df).withColumn("price_range", tiers.right_closed_cut(F.col("actual")))
    per = (agg_with_quantiles(d.filter(F.col("price_range").isNotNull()), ["price_range"],
                              [F.avg("pct_error").alias("mean_pct_error"), F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mean_abs_error")],
                              {"median_pct_error": ("pct_error", 0.5)})
           .withColumn("section", F.lit("by_price_range")))
    return rows.unionByName(z).unionByName(per, allowMissingColumns=True)


def value_counts(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Top ``n`` values by count (ties by value) and the number of distinct values."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = g.orderBy(F.col("n").desc(), F.col(col)).limit(n)
    n_distinct = g.count()
    return top.withColumn("n_distinct", F.lit(n_distinct).cast("bigint"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: list[int]) -> DataFrame:
    """Counts per (actual, predicted) class, pivoted, with overall accuracy."""
    piv = (df.groupBy(F.col(actual).alias("actual_tier")).pivot(predicted, classes)
             .agg(F.count(F.lit(1))).fillna(0))
    piv = piv.withColumnsRenamed({str(c): f"pred_{c}" for c in classes})
    diag = reduce(lambda a, b: a + b, [F.when(F.col("actual_tier") == c, F.col(f"pred_{c}")).otherwise(0)
                                       for c in classes])
    total = reduce(lambda a, b: a + b, [F.col(f"pred_{c}") for c in classes])
    w = Window.partitionBy()  # runs over len(classes) rows
    return piv.withColumn("accuracy", F.sum(diag).over(w) / F.sum(total).over(w))


def metrics_by_tier(df: DataFrame, tier_col: str) -> DataFrame:
    """Per tier: count, MedAPE, MAE, R2, within 20 %."""
    a, p = F.col("actual"), F.col("predicted")
    ape = F.abs(F.try_divide(a - p, a)) * 100
    return agg_with_quantiles(df, [tier_col], [
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(a - p)).alias("mae"),
        _r2(a, p).alias("r2"), (F.avg(F.when(ape <= 20, 1.0).otherwise(0.0)) * 100).alias("within_20")], {"medape": (ape, 0.5)})


def mape_weighting(df: DataFrame, method_col: str, tier_col: str, baseline: str) -> DataFrame:
    """Row-weighted MAPE vs unweighted mean of tier MAPEs per method, and
    the improvement of each against the baseline method."""
    a, p = F.col("actual"), F.col("predicted")
    ape = F.abs(F.try_divide(a - p, a)) * 100
    per_tier = df.groupBy(method_col, tier_col).agg(F.avg(ape).alias("_m"), F.sum(ape).alias("_s"),
                                                    F.count(F.lit(1)).alias("_n"))
    m = per_tier.groupBy(method_col).agg((F.sum("_s") / F.sum("_n")).alias("weighted_mape"),
                                         F.avg("_m").alias("unweighted_mape"))
    b = m.filter(F.col(method_col) == baseline).first()   # one row per method
    bw = F.lit(b["weighted_mape"] if b else None).cast("double")
    bu = F.lit(b["unweighted_mape"] if b else None).cast("double")
    return m.select(method_col, "weighted_mape", "unweighted_mape",
                    (F.try_divide(bw - F.col("weighted_mape"), bw) * 100).alias("weighted_gain_pct"),
                    (F.try_divide(bu - F.col("unweighted_mape"), bu) * 100).alias("unweighted_gain_pct"))


def method_comparison(df: DataFrame, method_col: str, baseline: str) -> DataFrame:
    """Per method MAPE / MAE / R2, gain vs the baseline method, best flag."""
    a, p = F.col("actual"), F.col("predicted")
    ape = F.abs(F.try_divide(a - p, a)) * 100
    m = df.groupBy(method_col).agg(F.count(F.lit(1)).alias("n"), F.avg(ape).alias("mape"),
                                   F.avg(F.abs(a - p)).alias("mae"), _r2(a, p).alias("r2"))
    b = m.filter(F.col(method_col) == baseline).first()   # one row per method
    bm = F.lit(b["mape"] if b else None).cast("double")
    w = Window.partitionBy()  # runs over one row per method
    return m.select(method_col, "n", "mape", "mae", "r2",
                    F.when(F.col("mape") == bm, F.lit(0.0))
                     .otherwise(F.try_divide(bm - F.col("mape"), bm) * 100).alias("vs_baseline_pct"),
                    (F.col("mape") == F.min("mape").over(w)).alias("is_best"))


def method_by_tier(df: DataFrame, method_col: str, tier_col: str, methods: list[str]) -> DataFrame:
    """MAPE of every method per tier (one column each) and the tier's best
    method (the first of ``methods`` among equals)."""
    a, p = F.col("actual"), F.col("predicted")
    piv = (df.groupBy(tier_col).pivot(method_col, methods).agg(F.avg(F.abs(F.try_divide(a - p, a)) * 100))
             .withColumnsRenamed({m: f"mape_{m.lower()}" for m in methods}))
    cells = F.array(*[F.struct(F.col(f"mape_{m.lower()}").alias("mape"), F.lit(i).alias("i"), F.lit(m).alias("method")) for i, m in enumerate(methods)])
    return piv.withColumn("best_method", F.array_min(F.filter(cells, lambda c: c["mape"].isNotNull()))["method"])


def ab_lift(df: DataFrame, method_col: str, tier_col: str, base: str, treat: str) -> DataFrame:
    """Baseline vs treatment MAPE / MAE / R2 per tier, MAPE improvement, and
    an ``overall`` row from the tier means."""
    a, p = F.col("actual"), F.col("predicted")
    ape = F.abs(F.try_divide(a - p, a)) * 100
    per = (df.filter(F.col(method_col).isin(base, treat)).groupBy(tier_col, method_col)
             .agg(F.count(F.lit(1)).alias("n"), F.avg(ape).alias("mape"), F.avg(F.abs(a - p)).alias("mae"),
                  _r2(a, p).alias("r2")))
    pick = lambda m, c: F.first(F.when(F.col(method_col) == m, F.col(c)), ignorenulls=True)
    t = per.groupBy(tier_col).agg(pick(base, "n").alias("n_samples"),
                                  pick(base, "mape").alias("baseline_mape"), pick(treat, "mape").alias("topics_mape"),
                                  pick(base, "mae").alias("baseline_mae"), pick(treat, "mae").alias("topics_mae"),
                                  pick(base, "r2").alias("baseline_r2"), pick(treat, "r2").alias("topics_r2"))
    t = t.withColumn("mape_improvement_pct",
                     F.try_divide(F.col("baseline_mape") - F.col("topics_mape"), F.col("baseline_mape")) * 100)
    overall = t.agg(F.lit("overall").alias(tier_col), F.sum("n_samples").alias("n_samples"),
                    F.avg("baseline_mape").alias("baseline_mape"), F.avg("topics_mape").alias("topics_mape"),
                    F.avg("baseline_mae").alias("baseline_mae"), F.avg("topics_mae").alias("topics_mae"),
                    F.avg("baseline_r2").alias("baseline_r2"), F.avg("topics_r2").alias("topics_r2"))
    overall = overall.withColumn("mape_improvement_pct",
                                 F.try_divide(F.col("baseline_mape") - F.col("topics_mape"), F.col("baseline_mape")) * 100)
    return t.unionByName(overall)


def single_vs_routed(df: DataFrame, method_col: str, single: str, routed: str) -> DataFrame:
    """R2, MAE, MedAPE, within-20 for two models side by side and differences."""
    m = metrics_by_tier(df.filter(F.col(method_col).isin(single, routed)), method_col)
    pick = lambda mm, c: F.first(F.when(F.col(method_col) == mm, F.col(c)), ignorenulls=True)
    cols = []
    for c in ("r2", "mae", "medape", "within_20"):
        cols += [pick(single, c).alias(f"single_{c}"), pick(routed, c).alias(f"routed_{c}")]
    out = m.agg(*cols)
    return out.withColumns({f"diff_{c}": F.col(f"routed_{c}") - F.col(f"single_{c}")
                            for c in ("r2", "mae", "medape", "within_20")})


def confidence_label(predicted: Column) -> Column:
    """Confidence by predicted range (the single model's published MedAPE)."""
    # Labels by predicted price range.
    return (F.when((predicted >= 200000) & (predicted <= 1000000), F.lit("High (MedAPE ~10-11%)"))
             .when(predicted < 200000, F.lit("Medium (MedAPE ~29%)"))
             .otherwise(F.lit("Medium-High (MedAPE ~13%)")))
