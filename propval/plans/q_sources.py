"""Source, sink, schema and report queries (survey 2.1, 2.2) and the exact
topic-table keys (sparsify, coherence)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propval.functions import tiers
from propval.functions.groups import FEATURE_GROUPS
from propval.operators import features as FE
from propval.operators import metrics as M
from propval.operators import reports as R
from propval.operators import schema as S
from propval.operators import topic_reports as TR
from propval.plans.oracle_fixtures import tier_case, with_fx
from propval.plans.q_extract import extract
from propval.plans.q_features import OUTLIER_CTES, prior_sale_input
from propval.plans.q_metrics import method_predictions, predictions, topic_terms
from propval.plans.registry import query, rounded
from propval.sources import fixtures as fx
from propval.sources.io import stored
from propval.sources import io

_CSV_COLS = ["cc_list_id", "price", "a_date", "state", "city", "gla_sqft", "pool_spa_types"]
_CSV_SCHEMA = T.StructType([T.StructField("CC_LIST_ID", T.LongType()), T.StructField("PRICE", T.DoubleType()),
                            T.StructField("A_DATE", T.DateType()), T.StructField("STATE", T.StringType()),
                            T.StructField("CITY", T.StringType()), T.StructField("GLA_SQFT", T.DoubleType()),
                            T.StructField("POOL_SPA_TYPES", T.StringType())])


@query("q_csv_scan", rounded(with_fx(f"SELECT {', '.join(_CSV_COLS)} FROM fx_listings", ["fx_listings"]),
                             ["price", "gla_sqft"]))
def q_csv_scan(spark, sf):
    """CSV round trip: write with an upper-case header, read with an explicit
    schema (no inference pass), lower-case the names."""
    path = io.output_dir(spark, "csv-scan")
    src = fx.listings(spark, sf).select(*[F.col(c).alias(c.upper()) for c in _CSV_COLS])
    io.write_csv(src, path)
    return io.read_csv(spark, path, _CSV_SCHEMA)


@query("q_resolve_columns", rounded(with_fx("SELECT cc_list_id AS id, price, state FROM fx_listings", ["fx_listings"]),
                                    ["price"]))
def q_resolve_columns(spark, sf):
    """First present candidate for price / id / state (plan-time lookup)."""
    d = fx.listings(spark, sf)
    y = FE.resolve_column(d, ["sale_price", "currentsalesprice", "price", "saleprice"])
    i = FE.resolve_column(d, ["cc_list_id", "property_id", "propertyid", "id"])
    s = FE.resolve_column(d, ["sample_state", "state", "state_code"])
    return d.select(F.col(i).alias("id"), F.col(y).alias("price"), F.col(s).alias("state"))


_NARROW_INT = ["year_built", "effective_year_built", "bedrooms", "full_baths", "garage_spaces", "fireplace_count",
               "assessed_year", "mls_days_on_market"]
_NARROW_DBL = ["price", "latitude", "longitude", "gla_sqft", "lot_sqft", "hoa_fee_amount", "assessed_total_value",
               "tax_amount", "most_recent_sale"]


@query("q_narrow_types", rounded(with_fx(
    "SELECT cc_list_id, " + ", ".join([f"CAST({c} AS INTEGER) AS {c}" for c in _NARROW_INT] +
                                      ["CAST(half_baths AS TINYINT) AS half_baths"] +
                                      [f"CAST({c} AS FLOAT) AS {c}" for c in _NARROW_DBL]) + " FROM fx_listings",
    ["fx_listings"]), _NARROW_DBL))
def q_narrow_types(spark, sf):
    """float64 -> float32, 0/1 integers -> int8, other integers -> int32."""
    d = fx.listings(spark, sf).select("cc_list_id", *_NARROW_INT, "half_baths", *_NARROW_DBL)
    return S.narrow_types(d, exclude=("cc_list_id",))


_ROUTER = "CASE WHEN {c} < 200000 THEN 0 WHEN {c} < 1000000 THEN 1 ELSE 2 END"
_APE = "abs((actual - predicted) / actual) * 100"
_R2 = ("CASE WHEN var_pop(actual) * COUNT(actual) > 0 THEN 1.0::DOUBLE - SUM(pow(actual - predicted, 2)) "
       "/ (var_pop(actual) * COUNT(actual)) END")
_TIER_SQL = f"""
SELECT {_ROUTER.format(c='actual')} AS tier, COUNT(*) AS n, quantile_cont({_APE}, 0.5) AS medape,
  AVG(abs(actual - predicted)) AS mae, {_R2} AS r2,
  AVG(CASE WHEN {_APE} <= 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS within_20
FROM fx_predictions GROUP BY 1"""


@query("q_write_results", rounded(with_fx(_TIER_SQL, ["fx_predictions"]), ["medape", "mae", "r2", "within_20"]))
def q_write_results(spark, sf):
    """Write predictions and tier metrics as CSV sinks; return the metrics
    read back with their schema."""
    p = predictions(spark, sf).withColumn("tier", tiers.router_tier(F.col("actual")))
    m = M.metrics_by_tier(p, "tier")
    base = io.output_dir(spark, "results")
    io.write_csv(p.select("property_id", "state", "actual", "predicted", "price_tier"), f"{base}/predictions")
    io.write_csv(m, f"{base}/tier_metrics")
    return io.read_csv(spark, f"{base}/tier_metrics", m.schema)


_PRED_R2 = _R2


@query("q_report_summary", rounded(with_fx("""
SELECT metric, value_num, value_text FROM (
  SELECT 'total_properties' AS metric, CAST(COUNT(*) AS DOUBLE) AS value_num, NULL::VARCHAR AS value_text FROM fx_predictions
  UNION ALL SELECT 'states_included', CAST(COUNT(DISTINCT state) AS DOUBLE), NULL FROM fx_predictions
  UNION ALL SELECT 'overall_r2', """ + _PRED_R2 + """, NULL FROM fx_predictions
  UNION ALL SELECT 'overall_mae', AVG(abs(actual - predicted)), NULL FROM fx_predictions
  UNION ALL SELECT 'overall_mape', AVG(abs((actual - predicted) / actual)) * 100, NULL FROM fx_predictions
  UNION ALL SELECT 'price_tiers_trained', 8.0, NULL
  UNION ALL SELECT 'total_features', 40.0, NULL
  UNION ALL SELECT 'configuration', NULL, 'MLS+Census+Neighborhood'
  UNION ALL SELECT 'toggle_mls', NULL, 'enabled'
  UNION ALL SELECT 'toggle_census', NULL, 'enabled'
  UNION ALL SELECT 'toggle_neighborhood', NULL, 'enabled'
  UNION ALL SELECT 'toggle_image', NULL, 'disabled') t""", ["fx_predictions"]), ["value_num"]))
def q_report_summary(spark, sf):
    """Executive summary (workbook tab 1) as a key/value table."""
    toggles = {"mls": True, "census": True, "neighborhood": True, "image": False}
    return R.report_summary(predictions(spark, sf), 8, 40, "MLS+Census+Neighborhood", toggles)


_T70 = format(int(round(0.7 * 65536)), "04x")
_IS_TRAIN = f"substr(md5(CAST(property_id AS STRING) || '|42'), 1, 4) < '{_T70}'"


@query("q_report_tiers", rounded(with_fx(f"""
SELECT m.price_tier, m.n_train, m.n_test, m.r2, m.mae, m.mape, m.coverage_80, f.original,
  f.original - f.final AS filtered, (f.original - f.final) / f.original * 100 AS filter_pct
FROM (SELECT price_tier, COUNT(*) FILTER (WHERE {_IS_TRAIN}) AS n_train,
        COUNT(*) FILTER (WHERE NOT ({_IS_TRAIN})) AS n_test,
        {_R2.replace('actual', 'CASE WHEN NOT (' + _IS_TRAIN + ') THEN actual END')} AS r2,
        AVG(abs(actual - predicted)) FILTER (WHERE NOT ({_IS_TRAIN})) AS mae,
        AVG({_APE}) FILTER (WHERE NOT ({_IS_TRAIN})) AS mape,
        AVG(CASE WHEN actual BETWEEN predicted * 0.85 AND predicted * 1.15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
          FILTER (WHERE NOT ({_IS_TRAIN})) * 100 AS coverage_80
      FROM fx_method_predictions WHERE method = 'LDA' GROUP BY price_tier) m
LEFT JOIN (SELECT tg.price_tier, COUNT(*) AS original, (SELECT COUNT(*) FROM s4 WHERE s4.price_tier = tg.price_tier) AS final
           FROM tg GROUP BY tg.price_tier) f USING (price_tier)""",
    ["fx_method_predictions", "fx_extract"], OUTLIER_CTES), ["r2", "mae", "mape", "coverage_80", "filter_pct"]))
def q_report_tiers(spark, sf):
    """Tier performance (workbook tab 2): train/test counts, test R2 / MAE /
    MAPE / 80 % coverage, and outlier-filter statistics."""
    mp = method_predictions(spark, sf).filter(F.col("method") == "LDA")
    tr = FE.hash_split(F.col("property_id"), 0.7)
    a, p = F.col("actual"), F.col("predicted")
    test = mp.withColumn("_test", ~tr)
    ta = F.when(F.col("_test"), a)
    inside = F.when(a.between(p * 0.85, p * 1.15), 1.0).otherwise(0.0)
    tm = test.groupBy("price_tier").agg(
        F.count(F.when(~F.col("_test"), 1)).alias("n_train"), F.count(F.when(F.col("_test"), 1)).alias("n_test"),
        M._r2(ta, p).alias("r2"), F.avg(F.when(F.col("_test"), F.abs(a - p))).alias("mae"),
        F.avg(F.when(F.col("_test"), F.abs(F.try_divide(a - p, a)) * 100)).alias("mape"),
        (F.avg(F.when(F.col("_test"), inside)) * 100).alias("coverage_80"))
    e = extract(spark, sf).withColumn("price_tier", tiers.price_tier(F.col("sale_price"), tiers.PRICE_TIERS_POOLED))
    _, stats = FE.outlier_filter(e, "sale_price")
    return R.report_tiers(tm, stats).select("price_tier", "n_train", "n_test", "r2", "mae", "mape", "coverage_80",
                                            "original", "filtered", "filter_pct")


# Expressions whose non-NULL count the oracle uses for every present feature.
_FEAT_SQL = {
    "sqft_per_bedroom": "living_sqft / (bedrooms + 1)", "lot_to_living_ratio": "lot_sqft / (living_sqft + 1)",
    "property_age": "year_built", "is_new": "1", "has_garage": "1", "log_sqft": "living_sqft",
    "age_squared": "year_built", "luxury_score": "living_sqft + full_baths + garage_spaces",
    "prior_sale_price": "COALESCE(previous_sale_price, median_home_value)",
    "prior_price_per_sqft": "previous_sale_price / (living_sqft + 1)",
    "sqft_per_prior_dollar": "living_sqft / (previous_sale_price + 1)", "years_since_last_sale": "1",
    "expected_appreciation": "previous_sale_price + datediff('day', previous_sale_date, DATE '2024-01-01')",
    "has_prior_sale": "1", "recently_sold": "1",
    "income_education_score": "median_household_income * pct_bachelors_degree",
}
_ABSENT = {"geo_cluster", "cluster_avg_price", "cluster_med_price"} | set(FEATURE_GROUPS["image"]["topics"]) | \
    set(FEATURE_GROUPS["image"]["conditions"])
_ALL_ON = {"mls": True, "census": True, "neighborhood": True, "image": True}


def _groups_sql() -> str:
    parts = []
    for toggle, groups in FEATURE_GROUPS.items():
        for g, feats in groups.items():
            for f in feats:
                if f in _ABSENT:
                    parts.append(f"SELECT '{toggle}' AS toggle, '{g}' AS \"group\", '{f}' AS feature, false AS present, "
                                 f"CAST(0 AS BIGINT) AS n_non_null, false AS available")
                else:
                    e = _FEAT_SQL.get(f, f)
                    parts.append(f"SELECT '{toggle}' AS toggle, '{g}' AS \"group\", '{f}' AS feature, true AS present, "
                                 f"COUNT({e}) AS n_non_null, COUNT({e}) > 0 AS available FROM fx_extract")
    return "\nUNION ALL ".join(parts)


@query("q_feature_groups", with_fx(_groups_sql(), ["fx_extract"]))
def q_feature_groups(spark, sf):
    """Feature discovery with toggles: present / available per group (one
    non-NULL counting pass over the engineered extract)."""
    d = FE.features_prior_sale(FE.features_pooled(prior_sale_input(spark, sf)))
    return S.feature_availability(d, _ALL_ON)


MODEL_FEATURES = ["gla_sqft", "lot_sqft", "bedrooms", "full_baths", "half_baths", "year_built", "property_age",
                  "effective_age", "total_baths", "gla_to_lot_ratio", "sqft_per_bedroom", "has_garage", "has_pool",
                  "has_fireplace", "hoa_monthly", "topic_1", "topic_2", "topic_3", "pool_private"]


@query("q_align_schema", rounded(with_fx("""
SELECT cc_list_id, gla_sqft, lot_sqft, bedrooms, full_baths, half_baths, year_built,
  CASE WHEN year_built IS NULL THEN NULL ELSE LEAST(GREATEST(2026 - year_built, 0), 200) END AS property_age,
  CASE WHEN effective_year_built IS NULL THEN NULL ELSE LEAST(GREATEST(2026 - effective_year_built, 0), 200) END
    AS effective_age,
  full_baths + 0.5::DOUBLE * COALESCE(half_baths, 0) AS total_baths,
  CAST(gla_sqft AS DOUBLE) / (lot_sqft + 1) AS gla_to_lot_ratio,
  CAST(gla_sqft AS DOUBLE) / (bedrooms + 1) AS sqft_per_bedroom,
  CAST(COALESCE(garage_spaces > 0, false) AS TINYINT) AS has_garage,
  CAST(pool_spa_types IS NOT NULL AS INTEGER) AS has_pool,
  CAST(COALESCE(fireplace_count > 0, false) AS TINYINT) AS has_fireplace,
  COALESCE(hoa_fee_amount, 0.0) AS hoa_monthly, 0 AS topic_1, 0 AS topic_2, 0 AS topic_3, 0 AS pool_private
FROM fx_listings""", ["fx_listings"]),
    ["gla_sqft", "lot_sqft", "total_baths", "gla_to_lot_ratio", "sqft_per_bedroom", "hoa_monthly"]))
def q_align_schema(spark, sf):
    """Align engineered listings to a model's feature list: missing columns
    (dummy topics, unseen flags) become 0, order follows the model."""
    return S.align_schema(FE.features_listing(fx.listings(spark, sf)), MODEL_FEATURES, keep=("cc_list_id",))


@query("q_topic_sparsify", rounded(with_fx("""
SELECT CAST(topic AS INTEGER) AS topic, term, weight / SUM(weight) OVER (PARTITION BY topic) AS weight,
  CAST(rank AS INTEGER) AS rank
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM fx_topic_terms) t
WHERE rank <= 20""", ["fx_topic_terms"]), ["weight"]))
def q_topic_sparsify(spark, sf):
    """Keep the top 20 terms per topic and renormalise them to sum 1."""
    from propval.operators.topics import sparsify_topics
    return sparsify_topics(topic_terms(spark, sf), 20)


_FOLD = ", ".join(f"SUM(n * p{i} / all_p) / SUM(n) AS topic_{i}" for i in range(1, 9))


@query("q_topic_foldin", rounded(with_fx(f"""
SELECT property_id, {_FOLD} FROM (SELECT *, {" + ".join(f"p{i}" for i in range(1, 9))} AS all_p FROM
  (SELECT l.property_id, l.n, {", ".join(f"SUM(CASE WHEN s.topic = {i} THEN s.weight ELSE 0 END) AS p{i}" for i in range(1, 9))}
   FROM (SELECT property_id, tag, COUNT(*) AS n FROM fx_tag_long GROUP BY 1, 2) l JOIN sparse s ON s.term = l.tag GROUP BY l.property_id, l.tag, l.n) x) y
WHERE all_p > 0 GROUP BY property_id""", ["fx_tag_long", "fx_topic_terms"], [
    ("sparse", """SELECT topic, term, weight / SUM(weight) OVER (PARTITION BY topic) AS weight FROM (SELECT *, ROW_NUMBER() OVER
                  (PARTITION BY topic ORDER BY weight DESC, term) AS r FROM fx_topic_terms) WHERE r <= 20""")]), [f"topic_{i}" for i in range(1, 9)]))
def q_topic_foldin(spark, sf):
    """One-step responsibilities of tag documents under sparsified topics."""
    from propval.operators.tags import explode_tags
    from propval.operators.topics import fold_in, sparsify_topics
    counts = explode_tags(fx.tagged(spark, sf)).groupBy("property_id", F.col("tag").alias("term")).agg(F.count("*").alias("n"))
    return fold_in(counts, sparsify_topics(topic_terms(spark, sf), 20), 8)


_EPS = "1e-12"


@query("q_topic_coherence", rounded(with_fx(f"""
SELECT topic, AVG(cos) AS coherence FROM (
  SELECT v.topic, v.wi, SUM(v.npmi * s.vw) / (sqrt(SUM(v.npmi * v.npmi)) * sqrt(MAX(n2.nrm))) AS cos
  FROM npmi v JOIN vsum s ON v.topic = s.topic AND v.wj = s.wk
  JOIN (SELECT topic, SUM(vw * vw) AS nrm FROM vsum GROUP BY topic) n2 ON n2.topic = v.topic
  GROUP BY v.topic, v.wi) t
GROUP BY topic""", ["fx_tag_long", "fx_tagged", "fx_topic_terms"], [
    ("tops", """SELECT CAST(topic AS INTEGER) AS topic, term FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY topic
               ORDER BY weight DESC, term) AS r FROM fx_topic_terms) WHERE r <= 10"""),
    ("nd", "SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM fx_tagged"),
    ("dfw", "SELECT tag AS term, COUNT(*) AS df FROM fx_tag_long WHERE tag IN (SELECT term FROM tops) GROUP BY tag"),
    ("co", """SELECT a.tag AS wa, b.tag AS wb, COUNT(*) AS n FROM fx_tag_long a JOIN fx_tag_long b
              ON a.property_id = b.property_id WHERE a.tag IN (SELECT term FROM tops) AND b.tag IN (SELECT term FROM tops)
              GROUP BY 1, 2"""),
    ("npmi", f"""SELECT x.topic, x.term AS wi, y.term AS wj,
               ln((COALESCE(co.n, 0) / nd.n + {_EPS}) / ((da.df / nd.n) * (db.df / nd.n)))
               / -ln(COALESCE(co.n, 0) / nd.n + {_EPS}) AS npmi
               FROM tops x JOIN tops y ON x.topic = y.topic
               JOIN dfw da ON da.term = x.term JOIN dfw db ON db.term = y.term
               LEFT JOIN co ON co.wa = x.term AND co.wb = y.term, nd"""),
    ("vsum", "SELECT topic, wj AS wk, SUM(npmi) AS vw FROM npmi GROUP BY topic, wj"),
]), ["coherence"]))
def q_topic_coherence(spark, sf):
    """C_V coherence of each topic's top-10 terms over the tag documents
    (document-wide window): NPMI vectors and their cosine to the topic sum."""
    from propval.operators.topics import cv_coherence
    t = stored(fx.tagged(spark, sf), "tags")
    return cv_coherence(topic_terms(spark, sf, t), t, 10)
