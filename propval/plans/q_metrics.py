"""Metric, importance and topic-report queries (survey 2.4-2.7, 2.1 reports).

The inputs are deterministic stand-ins computed from the extract: a
prediction table (prediction = actual x (1 + ((id * prime) mod 41 - 20) /
100)), per-method predictions, a correlation-based importance table and a
normalised topic table, so every metric is checkable against DuckDB.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from propval.functions import tiers
from propval.operators import importance as IM
from propval.operators import metrics as M
from propval.operators import topic_reports as TR
from propval.functions.quantiles import agg_with_quantiles
from propval.operators.features import clip, hash_split
from propval.operators.tags import explode_tags, frequency_rank, tag_counts
from propval.plans.oracle_fixtures import IMPORTANCE_FEATURES, METHODS, N_TOPICS, with_fx
from propval.plans.q_extract import extract
from propval.plans.registry import query, rounded, round_half_up
from propval.sources import fixtures as fx
from propval.sources.io import stored


def _pred(prime: int):
    return F.col("sale_price") * (1 + ((F.col("property_id") * prime) % 41 - 20).cast("double") / 100)


def predictions(spark, sf):
    """The prediction table, derived once: metrics and the ranks of quantiles
    both read it, so it is written to a table of its own."""
    e = extract(spark, sf)
    p = _pred(7919)
    rows = e.select("property_id", "state", F.col("sale_price").alias("actual"), p.alias("predicted"),
                    (p * 0.85).alias("pred_lower"), (p * 1.15).alias("pred_upper"),
                    tiers.price_tier(F.col("sale_price")).alias("price_tier"),
                    "living_sqft", "bedrooms", clip(F.lit(2026) - F.col("year_built"), 0, 200).alias("property_age"),
                    "lot_sqft", (F.col("full_baths") + 0.5 * F.coalesce(F.col("half_baths"), F.lit(0))).alias("total_baths"))
    return stored(rows, "predictions")


def method_predictions(spark, sf):
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), _pred(p).alias("predicted")) for m, p in METHODS]))
    rows = extract(spark, sf).select("property_id", "sale_price", each.alias("x"))
    return stored(rows.select("property_id", "x.method", F.col("sale_price").alias("actual"), "x.predicted",
                              tiers.price_tier(F.col("sale_price"), tiers.PRICE_TIERS_POOLED).alias("price_tier")), "methods")


def importance_table(spark, sf):
    """|corr(feature, price)| per router tier (rounded to 6 digits) and the
    number of test rows of the tier."""
    e = extract(spark, sf)
    long = e.select("property_id", "sale_price", tiers.router_tier(F.col("sale_price")).alias("tier"),
                    F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v"))
                                        for f in IMPORTANCE_FEATURES])).alias("_kv"))
    r = F.abs(F.corr("_kv.v", "sale_price"))
    imp = F.coalesce(F.when(F.isnan(r), F.lit(0.0)).otherwise(r), F.lit(0.0))
    return long.groupBy("tier", F.col("_kv.feature").alias("feature")).agg(
        round_half_up(imp).alias("importance"),
        F.count(F.when(~hash_split(F.col("property_id"), 0.8), 1)).alias("n_test"))


def topic_table(spark, sf):
    e = extract(spark, sf).select("property_id", "sale_price")
    raw = [(F.col("property_id") * (7 + 31 * j)) % 97 + 1 for j in range(1, N_TOPICS + 1)]
    total = reduce(lambda a, b: a + b, raw)
    t = e.select("property_id", "sale_price", tiers.price_tier(F.col("sale_price")).alias("price_tier"),
                 *[(r.cast("double") / total).alias(f"topic_{j}") for j, r in enumerate(raw, 1)])
    return t.withColumn("dominant_topic", TR.dominant_topic(TR.topic_cols(N_TOPICS)))


def topic_terms(spark, sf, tagged=None):
    c = frequency_rank(tag_counts(explode_tags(fx.tagged(spark, sf) if tagged is None else tagged)), "rk")
    topics = F.explode(F.array(*[F.lit(j) for j in range(1, N_TOPICS + 1)]))
    return (c.withColumn("topic", topics).select(
        "topic", F.col("tag").alias("term"),
        (F.col("n_docs") * ((F.col("topic") * 13 + F.col("rk") * 7) % 23 + 1)).cast("double").alias("weight")))


_PE = ("pe", """SELECT *, actual - predicted AS error, abs(actual - predicted) AS abs_error,
  abs((actual - predicted) / actual) * 100 AS pct_error FROM fx_predictions""")
_APE = "abs((actual - predicted) / actual) * 100"
_R2 = ("CASE WHEN var_pop(actual) * COUNT(actual) > 0 THEN 1.0::DOUBLE - SUM(pow(actual - predicted, 2)) "
       "/ (var_pop(actual) * COUNT(actual)) END")
_WITHIN = "AVG(CASE WHEN {ape} <= {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100"
_REG = f"""COUNT(*) AS n, AVG(abs(actual - predicted)) AS mae, sqrt(AVG(pow(actual - predicted, 2))) AS rmse,
  {_R2} AS r2, AVG({_APE}) AS mape, quantile_cont({_APE}, 0.5) AS medape,
  AVG(CASE WHEN {_APE} < 100 THEN {_APE} END) AS mape_trimmed,
  {_WITHIN.format(ape=_APE, k=10)} AS within_10, {_WITHIN.format(ape=_APE, k=20)} AS within_20,
  {_WITHIN.format(ape=_APE, k=30)} AS within_30"""
_REG_D = ["mae", "rmse", "r2", "mape", "medape", "mape_trimmed", "within_10", "within_20", "within_30"]


@query("q_regression_metrics", rounded(with_fx(f"""
SELECT price_tier, {_REG} FROM fx_predictions GROUP BY price_tier
UNION ALL SELECT 'overall' AS price_tier, {_REG} FROM fx_predictions""", ["fx_predictions"]), _REG_D))
def q_regression_metrics(spark, sf):
    """MAE, RMSE, R2, MAPE, MedAPE, trimmed MAPE, within 10/20/30 % per tier and overall."""
    p = predictions(spark, sf)
    return M.regression_metrics(p, ["price_tier"]).unionByName(
        M.regression_metrics(p).withColumn("price_tier", F.lit("overall")))


def _range_case(col: str) -> str:
    parts = []
    for lo, hi, label in tiers.RANGES_4:
        parts.append(f"WHEN {col} >= {lo} THEN '{label}'" if hi == float("inf")
                     else f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def _cut_case(col: str) -> str:
    b, lab = tiers.CUT_BINS, tiers.CUT_LABELS
    return "CASE " + " ".join(f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{l}'"
                              for lo, hi, l in zip(b[:-1], b[1:], lab)) + " END"


@query("q_metrics_by_range", rounded(with_fx(f"""
SELECT price_range, quantile_cont(pct_error, 0.5) AS medape, AVG(abs_error) AS mae, COUNT(*) AS n
FROM (SELECT *, {_range_case('actual')} AS price_range FROM pe) t WHERE price_range IS NOT NULL
GROUP BY price_range""", ["fx_predictions"], [_PE]), ["medape", "mae"]))
def q_metrics_by_range(spark, sf):
    """MedAPE, MAE, count per [low, high) range of actual."""
    return M.metrics_by_range(predictions(spark, sf))


@query("q_metrics_by_cut", rounded(with_fx(f"""
SELECT price_range, COUNT(*) AS n, quantile_cont(error, 0.5) AS median_error,
  quantile_cont(pct_error, 0.5) AS medape, AVG(abs_error) AS mae, {_R2} AS r2
FROM (SELECT *, {_cut_case('actual')} AS price_range FROM pe) t WHERE price_range IS NOT NULL
GROUP BY price_range""", ["fx_predictions"], [_PE]), ["median_error", "medape", "mae", "r2"]))
def q_metrics_by_cut(spark, sf):
    """pd.cut-style (low, high] bins: count, median error, MedAPE, MAE, R2."""
    return M.metrics_by_cut(predictions(spark, sf))


@query("q_error_intervals", rounded(with_fx(f"""
SELECT price_range, n, lower, upper, upper - lower AS width FROM (
  SELECT price_range, COUNT(*) AS n, quantile_cont(pct_error, 0.05) AS lower, quantile_cont(pct_error, 0.95) AS upper
  FROM (SELECT *, {_cut_case('actual')} AS price_range FROM pe) t WHERE price_range IS NOT NULL
  GROUP BY price_range) g WHERE n > 10""", ["fx_predictions"], [_PE]), ["lower", "upper", "width"]))
def q_error_intervals(spark, sf):
    """p5 / p95 of % error and width per price bin with > 10 rows."""
    return M.error_intervals(predictions(spark, sf))


@query("q_interval_coverage", rounded(with_fx("""
SELECT price_tier, COUNT(*) AS n,
  AVG(CASE WHEN actual BETWEEN pred_lower AND pred_upper THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS coverage_pct
FROM fx_predictions GROUP BY price_tier""", ["fx_predictions"]), ["coverage_pct"]))
def q_interval_coverage(spark, sf):
    """% of actuals inside [q10, q90] prediction bounds per tier."""
    return M.interval_coverage(predictions(spark, sf), ["price_tier"])


_EXT_FEATS = ["living_sqft", "bedrooms", "property_age", "lot_sqft", "total_baths"]


@query("q_feature_extremes", rounded(with_fx("\nUNION ALL\n".join(f"""
SELECT '{f}' AS feature, side, threshold, COUNT(*) AS n, quantile_cont(pct_error, 0.5) AS medape,
  AVG(abs_error) AS mae
FROM (SELECT pe.pct_error, pe.abs_error, s.side, s.threshold FROM pe,
      (SELECT quantile_cont(CAST({f} AS DOUBLE), 0.1) AS p10, quantile_cont(CAST({f} AS DOUBLE), 0.9) AS p90 FROM pe) q,
      LATERAL (SELECT 'bottom_10' AS side, q.p10 AS threshold WHERE CAST(pe.{f} AS DOUBLE) <= q.p10
               UNION ALL SELECT 'top_10', q.p90 WHERE CAST(pe.{f} AS DOUBLE) >= q.p90) s) t
GROUP BY side, threshold""" for f in _EXT_FEATS), ["fx_predictions"], [_PE]), ["threshold", "medape", "mae"]))
def q_feature_extremes(spark, sf):
    """Count, MedAPE, MAE at <= p10 and >= p90 of five features."""
    return M.feature_extremes(predictions(spark, sf), _EXT_FEATS)


@query("q_decile_profile", rounded(with_fx("""
SELECT bin, e[bin + 1] AS bin_left, e[bin + 2] AS bin_right, COUNT(*) AS n, quantile_cont(pct_error, 0.5) AS medape
FROM (SELECT pe.pct_error, q.e,
        CAST(len(list_filter(q.e[2:len(q.e) - 1], lambda x: CAST(pe.living_sqft AS DOUBLE) > x)) AS INTEGER) AS bin
      FROM pe, (SELECT list_sort(list_distinct(quantile_cont(CAST(living_sqft AS DOUBLE),
                  [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM pe) q
      WHERE pe.living_sqft IS NOT NULL) t
GROUP BY bin, e""", ["fx_predictions"], [_PE]), ["bin_left", "bin_right", "medape"]))
def q_decile_profile(spark, sf):
    """qcut(living_sqft, 10, duplicates='drop'): median % error per bin."""
    return M.decile_profile(predictions(spark, sf), "living_sqft")


@query("q_zscore_outliers", rounded(with_fx("""
SELECT property_id, actual, predicted, error, pct_error, z_score, z_score > 3 AS z_gt_3 FROM (
  SELECT pe.*, abs((error - m.mu) / m.sd) AS z_score FROM pe,
    (SELECT AVG(error) AS mu, stddev_samp(error) AS sd FROM pe) m) t
WHERE z_score > 2""", ["fx_predictions"], [_PE]), ["actual", "predicted", "error", "pct_error", "z_score"]))
def q_zscore_outliers(spark, sf):
    """|z| of the signed error > 2 (sample std), flagged > 3."""
    return M.zscore_outliers(predictions(spark, sf))


@query("q_extrema_summary", rounded(with_fx("""
UNPIVOT (SELECT CAST(COUNT(*) AS DOUBLE) AS total_predictions, MIN(pct_error) AS best_error,
  MAX(pct_error) AS worst_error, quantile_cont(pct_error, 0.9) AS p90_error,
  quantile_cont(pct_error, 0.95) AS p95_error,
  CAST(COUNT(*) FILTER (WHERE abs((error - m.mu) / m.sd) > 3) AS DOUBLE) AS outliers_z3,
  AVG(CASE WHEN pct_error <= 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS within_10,
  AVG(CASE WHEN pct_error <= 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS within_20,
  AVG(CASE WHEN pct_error <= 30 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS within_30
  FROM pe, (SELECT AVG(error) AS mu, stddev_samp(error) AS sd FROM pe) m)
ON COLUMNS(*) INTO NAME metric VALUE value""", ["fx_predictions"], [_PE]), ["value"]))
def q_extrema_summary(spark, sf):
    """Key/value summary of the error distribution."""
    return M.extrema_summary(predictions(spark, sf))


_BW = """
(SELECT property_id, actual, predicted, error, pct_error, '{s}' AS section FROM pe
 ORDER BY {o}, property_id LIMIT 10)"""


@query("q_best_worst", rounded(with_fx(
    _BW.format(s="best", o="pct_error ASC") + " UNION ALL " + _BW.format(s="worst", o="pct_error DESC"),
    ["fx_predictions"], [_PE]), ["actual", "predicted", "error", "pct_error"]))
def q_best_worst(spark, sf):
    """10 smallest and 10 largest % errors."""
    return M.best_worst(predictions(spark, sf))


@query("q_over_under", rounded(with_fx(
    _BW.format(s="over", o="error ASC") + " UNION ALL " + _BW.format(s="under", o="error DESC"),
    ["fx_predictions"], [_PE]), ["actual", "predicted", "error", "pct_error"]))
def q_over_under(spark, sf):
    """10 largest over-predictions (predicted > actual) and under-predictions."""
    return M.over_under(predictions(spark, sf))


@query("q_extrema_report", rounded(with_fx(
    "SELECT property_id, actual, predicted, error, pct_error, section, NULL::VARCHAR AS price_range, "
    "NULL::DOUBLE AS median_pct_error, NULL::DOUBLE AS mean_pct_error, NULL::BIGINT AS n, "
    "NULL::DOUBLE AS mean_abs_error FROM (" +
    _BW.format(s="best", o="pct_error ASC") + " UNION ALL " + _BW.format(s="worst", o="pct_error DESC") +
    " UNION ALL " + _BW.format(s="over", o="error ASC") + " UNION ALL " + _BW.format(s="under", o="error DESC") +
    """ UNION ALL SELECT property_id, actual, predicted, error, pct_error, 'outliers' FROM
      (SELECT pe.*, abs((error - m.mu) / m.sd) AS z FROM pe, (SELECT AVG(error) AS mu, stddev_samp(error) AS sd FROM pe) m)
      WHERE z > 3) u
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 'by_price_range', price_range, quantile_cont(pct_error, 0.5), AVG(pct_error),
  COUNT(*), AVG(abs_error)
FROM (SELECT *, """ + _cut_case("actual") + """ AS price_range FROM pe) t WHERE price_range IS NOT NULL
GROUP BY price_range""", ["fx_predictions"], [_PE]),
    ["actual", "predicted", "error", "pct_error", "median_pct_error", "mean_pct_error", "mean_abs_error"]))
def q_extrema_report(spark, sf):
    """Best, worst, over, under, outliers and per-range aggregates in one table."""
    return M.extrema_report(predictions(spark, sf))


@query("q_value_counts", with_fx("""
SELECT state, COUNT(*) AS n, (SELECT COUNT(DISTINCT state) FROM fx_predictions) AS n_distinct
FROM fx_predictions GROUP BY state ORDER BY n DESC, state LIMIT 10""", ["fx_predictions"]))
def q_value_counts(spark, sf):
    """Top-10 states by count and the number of distinct states."""
    return M.value_counts(predictions(spark, sf), "state")


_ROUTER = "CASE WHEN {c} < 200000 THEN 0 WHEN {c} < 1000000 THEN 1 ELSE 2 END"


@query("q_confusion_matrix", rounded(with_fx(f"""
SELECT actual_tier, pred_0, pred_1, pred_2,
  SUM(CASE actual_tier WHEN 0 THEN pred_0 WHEN 1 THEN pred_1 ELSE pred_2 END) OVER ()
    / SUM(pred_0 + pred_1 + pred_2) OVER () AS accuracy
FROM (SELECT {_ROUTER.format(c='actual')} AS actual_tier,
        COUNT(*) FILTER (WHERE {_ROUTER.format(c='predicted')} = 0) AS pred_0,
        COUNT(*) FILTER (WHERE {_ROUTER.format(c='predicted')} = 1) AS pred_1,
        COUNT(*) FILTER (WHERE {_ROUTER.format(c='predicted')} = 2) AS pred_2
      FROM fx_predictions GROUP BY 1) t""", ["fx_predictions"]), ["accuracy"]))
def q_confusion_matrix(spark, sf):
    """3x3 router-tier confusion counts and accuracy."""
    p = predictions(spark, sf).select(tiers.router_tier(F.col("actual")).alias("a"),
                                      tiers.router_tier(F.col("predicted")).alias("p"))
    return M.confusion_matrix(p, "a", "p", [0, 1, 2])


@query("q_metrics_by_tier", rounded(with_fx(f"""
SELECT {_ROUTER.format(c='actual')} AS tier, COUNT(*) AS n, quantile_cont({_APE}, 0.5) AS medape,
  AVG(abs(actual - predicted)) AS mae, {_R2} AS r2, {_WITHIN.format(ape=_APE, k=20)} AS within_20
FROM fx_predictions GROUP BY 1""", ["fx_predictions"]), ["medape", "mae", "r2", "within_20"]))
def q_metrics_by_tier(spark, sf):
    """Per actual router tier: count, MedAPE, MAE, R2, within 20 %."""
    p = predictions(spark, sf).withColumn("tier", tiers.router_tier(F.col("actual")))
    return M.metrics_by_tier(p, "tier")


@query("q_mape_weighting", rounded(with_fx(f"""
SELECT method, weighted_mape, unweighted_mape,
  (b.bw - weighted_mape) / b.bw * 100 AS weighted_gain_pct,
  (b.bu - unweighted_mape) / b.bu * 100 AS unweighted_gain_pct
FROM m, (SELECT weighted_mape AS bw, unweighted_mape AS bu FROM m WHERE method = 'LDA') b""",
    ["fx_method_predictions"], [("t", f"""SELECT method, price_tier, AVG({_APE}) AS tm, SUM({_APE}) AS ts, COUNT(*) AS tn
                                          FROM fx_method_predictions GROUP BY 1, 2"""),
                                ("m", """SELECT method, SUM(ts) / SUM(tn) AS weighted_mape, AVG(tm) AS unweighted_mape
                                          FROM t GROUP BY method""")]),
    ["weighted_mape", "unweighted_mape", "weighted_gain_pct", "unweighted_gain_pct"]))
def q_mape_weighting(spark, sf):
    """Row-weighted MAPE vs the mean of tier MAPEs, gains vs the LDA run."""
    return M.mape_weighting(method_predictions(spark, sf), "method", "price_tier", "LDA")


@query("q_method_comparison", rounded(with_fx(f"""
SELECT method, n, mape, mae, r2,
  CASE WHEN mape = b.bm THEN 0.0 ELSE (b.bm - mape) / b.bm * 100 END AS vs_baseline_pct,
  mape = MIN(mape) OVER () AS is_best
FROM (SELECT method, COUNT(*) AS n, AVG({_APE}) AS mape, AVG(abs(actual - predicted)) AS mae, {_R2} AS r2
      FROM fx_method_predictions GROUP BY method) m,
     (SELECT AVG({_APE}) AS bm FROM fx_method_predictions WHERE method = 'LDA') b""",
    ["fx_method_predictions"]), ["mape", "mae", "r2", "vs_baseline_pct"]))
def q_method_comparison(spark, sf):
    """Per topic method: MAPE / MAE / R2, % gain vs LDA, best method flag."""
    return M.method_comparison(method_predictions(spark, sf), "method", "LDA")


_METHODS = ["BASELINE", "LDA", "NMF", "BERTOPIC"]


@query("q_method_by_tier", rounded(with_fx(f"""
SELECT price_tier, {", ".join(f"MAX(m) FILTER (WHERE method = '{m}') AS mape_{m.lower()}" for m in _METHODS)},
  first(method ORDER BY m, list_position({_METHODS}, method)) AS best_method
FROM (SELECT price_tier, method, AVG({_APE}) AS m FROM fx_method_predictions GROUP BY 1, 2) t GROUP BY price_tier""",
    ["fx_method_predictions"]), [f"mape_{m.lower()}" for m in _METHODS]))
def q_method_by_tier(spark, sf):
    """MAPE per tier and method, and each tier's best method."""
    return M.method_by_tier(method_predictions(spark, sf), "method", "price_tier", _METHODS)


_AB_D = ["baseline_mape", "topics_mape", "baseline_mae", "topics_mae", "baseline_r2", "topics_r2",
         "mape_improvement_pct"]


@query("q_ab_lift", rounded(with_fx("""
SELECT *, (baseline_mape - topics_mape) / baseline_mape * 100 AS mape_improvement_pct FROM t
UNION ALL
SELECT 'overall', CAST(SUM(n_samples) AS BIGINT), AVG(baseline_mape), AVG(topics_mape), AVG(baseline_mae), AVG(topics_mae),
  AVG(baseline_r2), AVG(topics_r2), (AVG(baseline_mape) - AVG(topics_mape)) / AVG(baseline_mape) * 100 FROM t""",
    ["fx_method_predictions"], [
        ("g", f"""SELECT price_tier, method, COUNT(*) AS n, AVG({_APE}) AS mape, AVG(abs(actual - predicted)) AS mae,
                  {_R2} AS r2 FROM fx_method_predictions WHERE method IN ('BASELINE', 'LDA') GROUP BY 1, 2"""),
        ("t", """SELECT price_tier, MAX(n) FILTER (WHERE method = 'BASELINE') AS n_samples,
                   MAX(mape) FILTER (WHERE method = 'BASELINE') AS baseline_mape,
                   MAX(mape) FILTER (WHERE method = 'LDA') AS topics_mape,
                   MAX(mae) FILTER (WHERE method = 'BASELINE') AS baseline_mae,
                   MAX(mae) FILTER (WHERE method = 'LDA') AS topics_mae,
                   MAX(r2) FILTER (WHERE method = 'BASELINE') AS baseline_r2,
                   MAX(r2) FILTER (WHERE method = 'LDA') AS topics_r2
                 FROM g GROUP BY price_tier""")]), _AB_D))
def q_ab_lift(spark, sf):
    """Baseline vs with-topics metrics per tier, MAPE improvement, overall row."""
    return M.ab_lift(method_predictions(spark, sf), "method", "price_tier", "BASELINE", "LDA")


_SVR = ["r2", "mae", "medape", "within_20"]


@query("q_single_vs_routed", rounded(with_fx(
    "SELECT " + ", ".join(f"MAX({c}) FILTER (WHERE method = 'BASELINE') AS single_{c}, "
                          f"MAX({c}) FILTER (WHERE method = 'NMF') AS routed_{c}" for c in _SVR) + ", " +
    ", ".join(f"MAX({c}) FILTER (WHERE method = 'NMF') - MAX({c}) FILTER (WHERE method = 'BASELINE') AS diff_{c}"
              for c in _SVR) + " FROM m",
    ["fx_method_predictions"], [("m", f"""SELECT method, {_R2} AS r2, AVG(abs(actual - predicted)) AS mae,
        quantile_cont({_APE}, 0.5) AS medape, {_WITHIN.format(ape=_APE, k=20)} AS within_20
        FROM fx_method_predictions WHERE method IN ('BASELINE', 'NMF') GROUP BY method""")]),
    [f"{p}_{c}" for p in ("single", "routed", "diff") for c in _SVR]))
def q_single_vs_routed(spark, sf):
    """Single model vs routed model: R2, MAE, MedAPE, within-20 and differences."""
    return M.single_vs_routed(method_predictions(spark, sf), "method", "BASELINE", "NMF")


@query("q_score_confidence", rounded(with_fx("""
SELECT property_id, predicted,
  CASE WHEN predicted >= 200000 AND predicted <= 1000000 THEN 'High (MedAPE ~10-11%)'
       WHEN predicted < 200000 THEN 'Medium (MedAPE ~29%)' ELSE 'Medium-High (MedAPE ~13%)' END AS confidence
FROM fx_predictions""", ["fx_predictions"]), ["predicted"]))
def q_score_confidence(spark, sf):
    """Confidence label by predicted range (the batch-scoring label step)."""
    p = predictions(spark, sf)
    return p.select("property_id", "predicted", M.confidence_label(F.col("predicted")).alias("confidence"))


@query("q_concat_tiers", rounded(with_fx("""
SELECT property_id, state, actual, predicted, price_tier FROM fx_predictions""", ["fx_predictions"]),
    ["actual", "predicted"]))
def q_concat_tiers(spark, sf):
    """UNION ALL of per-tier prediction frames (one frame per tier)."""
    p = predictions(spark, sf).select("property_id", "state", "actual", "predicted", "price_tier")
    parts = [p.filter(F.col("price_tier") == t) for t in tiers.TIER_ORDER]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("q_profile", rounded(with_fx("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT cc_list_id) AS n_ids, MIN(price) AS min_price, MAX(price) AS max_price,
  quantile_cont(price, 0.01) AS p01, quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.5) AS p50,
  quantile_cont(price, 0.75) AS p75, quantile_cont(price, 0.99) AS p99
FROM fx_listings WHERE price IS NOT NULL""", ["fx_listings"]),
    ["min_price", "max_price", "p01", "p25", "p50", "p75", "p99"]))
def q_profile(spark, sf):
    """Row count, distinct ids, min/max and p1/p25/p50/p75/p99 of price (one pass)."""
    d = fx.listings(spark, sf).filter(F.col("price").isNotNull())
    return agg_with_quantiles(d, [], [F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cc_list_id").alias("n_ids"),
                                      F.min("price").alias("min_price"), F.max("price").alias("max_price")],
                              {f"p{k:02d}": ("price", k / 100) for k in (1, 25, 50, 75, 99)})


# ---------------------------------------------------------------- importance

@query("q_importance_rank", rounded(with_fx("""
SELECT tier, feature, importance, n_test, rank, pct_of_total, cumulative_pct,
  SUM(CASE WHEN rank <= 5 THEN importance END) OVER (PARTITION BY tier) / SUM(importance) OVER (PARTITION BY tier) * 100
    AS top5_share,
  SUM(CASE WHEN rank <= 10 THEN importance END) OVER (PARTITION BY tier) / SUM(importance) OVER (PARTITION BY tier) * 100
    AS top10_share
FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY tier ORDER BY importance DESC, feature) AS INTEGER) AS rank,
        importance / SUM(importance) OVER (PARTITION BY tier) * 100 AS pct_of_total,
        SUM(importance) OVER (PARTITION BY tier ORDER BY importance DESC, feature
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          / SUM(importance) OVER (PARTITION BY tier) * 100 AS cumulative_pct
      FROM fx_importance) t""", ["fx_importance"]),
    ["importance", "pct_of_total", "cumulative_pct", "top5_share", "top10_share"]))
def q_importance_rank(spark, sf):
    """Rank, % of total, cumulative share and top-5 / top-10 share per tier."""
    return IM.importance_rank(importance_table(spark, sf))


@query("q_importance_mean", rounded(with_fx("""
SELECT feature, AVG(importance) AS mean_importance FROM fx_importance GROUP BY feature
ORDER BY mean_importance DESC, feature LIMIT 20""", ["fx_importance"]), ["mean_importance"]))
def q_importance_mean(spark, sf):
    """Mean importance over tiers, top 20."""
    return IM.importance_mean(importance_table(spark, sf))


@query("q_importance_weighted", rounded(with_fx("""
SELECT feature, total_gain / SUM(total_gain) OVER () AS importance FROM (
  SELECT feature, SUM(importance * n_test) AS total_gain FROM fx_importance GROUP BY feature) g
ORDER BY total_gain DESC, feature LIMIT 100""", ["fx_importance"]), ["importance"]))
def q_importance_weighted(spark, sf):
    """Gain x n_test summed per feature, normalised to 1, top 100."""
    return IM.importance_weighted(importance_table(spark, sf))


@query("q_importance_pivot", rounded(with_fx("""
SELECT feature, COALESCE(MAX(importance) FILTER (WHERE tier = 0), 0.0) AS tier_0,
  COALESCE(MAX(importance) FILTER (WHERE tier = 1), 0.0) AS tier_1,
  COALESCE(MAX(importance) FILTER (WHERE tier = 2), 0.0) AS tier_2,
  GREATEST(COALESCE(MAX(importance) FILTER (WHERE tier = 0), 0.0), COALESCE(MAX(importance) FILTER (WHERE tier = 1), 0.0),
           COALESCE(MAX(importance) FILTER (WHERE tier = 2), 0.0)) AS max_importance
FROM fx_importance
WHERE feature IN (SELECT feature FROM (SELECT feature, ROW_NUMBER() OVER (PARTITION BY tier ORDER BY importance DESC, feature) AS r
                                       FROM fx_importance) WHERE r <= 15)
GROUP BY feature""", ["fx_importance"]), ["tier_0", "tier_1", "tier_2", "max_importance"]))
def q_importance_pivot(spark, sf):
    """Union of each tier's top 15, one column per tier (0 if absent), row max."""
    return IM.importance_pivot(importance_table(spark, sf), [0, 1, 2])


@query("q_importance_ratio", rounded(with_fx("""
SELECT tier, feature, importance,
  importance / ((SUM(importance) OVER (PARTITION BY feature) - importance) / 2 + 1e-10) AS relative_importance,
  LEAST(importance / ((SUM(importance) OVER (PARTITION BY feature) - importance) / 2 + 0.001), 10.0) AS uniqueness
FROM fx_importance""", ["fx_importance"]), ["importance", "relative_importance", "uniqueness"]))
def q_importance_ratio(spark, sf):
    """This tier's importance over the mean of the other tiers; capped uniqueness."""
    return IM.importance_ratio(importance_table(spark, sf), [0, 1, 2])


# -------------------------------------------------------------------- topics

_TC = [f"topic_{i}" for i in range(1, N_TOPICS + 1)]
_DOM = f"CAST(list_position([{', '.join(_TC)}], list_max([{', '.join(_TC)}])) AS INTEGER)"


@query("q_class_tfidf", rounded(with_fx("""
SELECT tf.topic, tf.tag AS term, tf.tf * ln(1 + a.a / tot.f) AS weight
FROM tf JOIN (SELECT tag, CAST(SUM(tf) AS DOUBLE) AS f FROM tf GROUP BY tag) tot USING (tag),
     (SELECT CAST(SUM(tf) AS DOUBLE) / COUNT(DISTINCT topic) AS a FROM tf) a""", ["fx_topics", "fx_tag_long"],
    [("tf", f"""SELECT d.topic, l.tag, COUNT(*) AS tf FROM fx_tag_long l
                JOIN (SELECT property_id, {_DOM} AS topic FROM fx_topics) d USING (property_id) GROUP BY 1, 2""")]), ["weight"]))
def q_class_tfidf(spark, sf):
    """Class TF-IDF of the tags of each dominant topic's documents."""
    from propval.operators.topics import class_tfidf
    topics = topic_table(spark, sf).select("property_id", F.col("dominant_topic").cast("int").alias("topic"))
    return class_tfidf(explode_tags(fx.tagged(spark, sf)), topics, "property_id", "tag")


@query("q_dominant_topic", rounded(with_fx(f"SELECT property_id, {', '.join(_TC)}, {_DOM} AS dominant_topic FROM fx_topics",
                                           ["fx_topics"]), _TC))
def q_dominant_topic(spark, sf):
    """1-based arg-max over topic columns, first on ties."""
    return topic_table(spark, sf).select("property_id", *_TC, "dominant_topic")


_TLONG = ("tl", "SELECT property_id, sale_price, price_tier, t.topic, [" + ", ".join(_TC) +
          f"][t.topic] AS score, {_DOM} AS dominant_topic FROM fx_topics, range(1, {N_TOPICS + 1}) AS t(topic)")


@query("q_topic_summary", rounded(with_fx("""
SELECT s.topic, s.num_properties, s.avg_topic_strength, w.top_5_features FROM (
  SELECT CAST(topic AS INTEGER) AS topic, COUNT(*) FILTER (WHERE dominant_topic = topic) AS num_properties,
    AVG(score) AS avg_topic_strength FROM tl GROUP BY topic) s
LEFT JOIN (SELECT CAST(topic AS INTEGER) AS topic, string_agg(term, ', ' ORDER BY r) AS top_5_features FROM (
  SELECT topic, term, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS r FROM fx_topic_terms)
  WHERE r <= 5 GROUP BY topic) w USING (topic)""", ["fx_topics", "fx_topic_terms"], [_TLONG]), ["avg_topic_strength"]))
def q_topic_summary(spark, sf):
    """Per topic: top-5 terms, properties where dominant, mean strength."""
    return TR.topic_summary(topic_table(spark, sf), topic_terms(spark, sf), N_TOPICS) \
             .select("topic", "num_properties", "avg_topic_strength", "top_5_features")


@query("q_topic_tier_profile", rounded(with_fx(f"""
SELECT price_tier, n, {', '.join(_TC)}, 'topic_' || CAST(list_position(a, list_max(a)) AS STRING) AS dominant_topic,
  list_max(a) AS dominant_score
FROM (SELECT price_tier, COUNT(*) AS n, {', '.join(f'AVG({c}) AS {c}' for c in _TC)},
        [{', '.join(f'AVG({c})' for c in _TC)}] AS a FROM fx_topics GROUP BY price_tier) g""", ["fx_topics"]),
    _TC + ["dominant_score"]))
def q_topic_tier_profile(spark, sf):
    """Mean of the 8 topics per price tier, dominant topic and its score."""
    return TR.topic_tier_profile(topic_table(spark, sf), N_TOPICS)


@query("q_topic_price_corr", rounded(with_fx("""
SELECT CAST(topic AS INTEGER) AS topic, correlation,
  CASE WHEN abs(correlation) > 0.3 THEN 'Strong' WHEN abs(correlation) > 0.15 THEN 'Moderate' ELSE 'Weak' END AS strength,
  CASE WHEN correlation > 0 THEN 'Higher prices' ELSE 'Lower prices' END AS direction
FROM (SELECT topic, corr(score, sale_price) AS correlation FROM tl GROUP BY topic) g""",
    ["fx_topics"], [_TLONG]), ["correlation"]))
def q_topic_price_corr(spark, sf):
    """Pearson r of each topic with price; strength and direction labels."""
    return TR.topic_price_corr(topic_table(spark, sf), N_TOPICS, "sale_price")


@query("q_topic_describe", rounded(with_fx("""
SELECT CAST(topic AS INTEGER) AS topic, AVG(score) AS mean, quantile_cont(score, 0.5) AS median, MAX(score) AS max,
  COUNT(*) FILTER (WHERE score > 0.3) AS n_above,
  AVG(CASE WHEN score > 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS pct_above
FROM tl GROUP BY topic""", ["fx_topics"], [_TLONG]), ["mean", "median", "max", "pct_above"]))
def q_topic_describe(spark, sf):
    """Mean, median, max and count / % above 0.3 per topic."""
    return TR.topic_describe(topic_table(spark, sf), N_TOPICS)


@query("q_topic_top_terms", rounded(with_fx("""
SELECT CAST(topic AS INTEGER) AS topic, term, weight, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM fx_topic_terms) t
WHERE rank <= 15""", ["fx_topic_terms"]), ["weight"]))
def q_topic_top_terms(spark, sf):
    """Top 15 terms per topic (row_number per topic)."""
    return TR.top_terms(topic_terms(spark, sf), 15)


@query("q_topic_top_rows", rounded(with_fx("""
SELECT property_id, sale_price, topic_3 FROM fx_topics ORDER BY topic_3 DESC, property_id LIMIT 10""",
                                           ["fx_topics"]), ["sale_price", "topic_3"]))
def q_topic_top_rows(spark, sf):
    """nlargest(10, topic_3) with an id tie-break."""
    return (topic_table(spark, sf).select("property_id", "sale_price", "topic_3")
            .orderBy(F.col("topic_3").desc(), "property_id").limit(10))
