"""Feature engineering, imputation, encoding and split queries (survey 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propval.functions import tiers
from propval.operators import features as FE
from propval.plans.oracle_fixtures import with_fx
from propval.plans.q_extract import LEAKY_COLUMNS, ID_COLUMNS, extract
from propval.plans.registry import query, rounded
from propval.sources import fixtures as fx

TRAIN80 = format(int(round(0.8 * 65536)), "04x")
TRAIN70 = format(int(round(0.7 * 65536)), "04x")


def _md5(col: str) -> str:
    return f"md5(CAST({col} AS STRING) || '|42')"


def listing_input(spark, sf):
    """Listing rows after the leaky / id drop and the target drop."""
    return FE.drop_leaky(fx.listings(spark, sf), LEAKY_COLUMNS + ID_COLUMNS, "price")


_CORE_SQL = """
  CAST(living_sqft AS DOUBLE) / (bedrooms + 1) AS sqft_per_bedroom,
  CAST(lot_sqft AS DOUBLE) / (living_sqft + 1) AS lot_to_living_ratio,
  2024 - year_built AS property_age,
  CAST(COALESCE(garage_spaces > 0, false) AS TINYINT) AS has_garage,
  ln(1 + CAST(living_sqft AS DOUBLE)) AS log_sqft"""
_CORE = ["sqft_per_bedroom", "lot_to_living_ratio", "property_age", "has_garage", "log_sqft"]


@query("q_features_core", rounded(with_fx(f"SELECT property_id, {_CORE_SQL} FROM fx_extract", ["fx_extract"]),
                                  ["sqft_per_bedroom", "lot_to_living_ratio", "log_sqft"]))
def q_features_core(spark, sf):
    """sqft/bedroom, lot/living, age (2024), has_garage, log1p(sqft)."""
    return FE.features_core(extract(spark, sf)).select("property_id", *_CORE)


_POOLED = _CORE + ["is_new", "age_squared", "luxury_score", "income_education_score"]


@query("q_features_pooled", rounded(with_fx(f"""
SELECT property_id, {_CORE_SQL},
  CAST(COALESCE(2024 - year_built <= 5, false) AS TINYINT) AS is_new,
  pow(CAST(2024 - year_built AS DOUBLE), 2) AS age_squared,
  (living_sqft / 1000 + CAST(full_baths AS DOUBLE) + CAST(garage_spaces AS DOUBLE)) / 3 AS luxury_score,
  median_household_income * pct_bachelors_degree AS income_education_score
FROM fx_extract""", ["fx_extract"]),
    ["sqft_per_bedroom", "lot_to_living_ratio", "log_sqft", "age_squared", "luxury_score", "income_education_score"]))
def q_features_pooled(spark, sf):
    """Core + is_new, age^2, luxury score (mean of available terms), income x education."""
    return FE.features_pooled(extract(spark, sf)).select("property_id", *_POOLED)


def prior_sale_input(spark, sf):
    return extract(spark, sf).withColumnsRenamed({"previous_sale_price": "prior_sale_price",
                                                  "previous_sale_date": "prior_sale_date"})


_PRIOR = ["prior_sale_price", "prior_price_per_sqft", "sqft_per_prior_dollar", "years_since_last_sale",
          "expected_appreciation", "has_prior_sale", "recently_sold"]


@query("q_features_prior_sale", rounded(with_fx("""
SELECT property_id,
  COALESCE(previous_sale_price, median_home_value) AS prior_sale_price,
  previous_sale_price / (living_sqft + 1) AS prior_price_per_sqft,
  living_sqft / (previous_sale_price + 1) AS sqft_per_prior_dollar,
  COALESCE(CAST(datediff('day', previous_sale_date, DATE '2024-01-01') AS DOUBLE) / 365.25::DOUBLE, 999.0)
    AS years_since_last_sale,
  previous_sale_price * pow(1.04::DOUBLE,
    CAST(datediff('day', previous_sale_date, DATE '2024-01-01') AS DOUBLE) / 365.25::DOUBLE) AS expected_appreciation,
  CAST(previous_sale_price IS NOT NULL AS TINYINT) AS has_prior_sale,
  CAST(COALESCE(CAST(datediff('day', previous_sale_date, DATE '2024-01-01') AS DOUBLE) / 365.25::DOUBLE < 2, false)
    AS TINYINT) AS recently_sold
FROM fx_extract""", ["fx_extract"]),
    ["prior_sale_price", "prior_price_per_sqft", "sqft_per_prior_dollar", "years_since_last_sale",
     "expected_appreciation"]))
def q_features_prior_sale(spark, sf):
    """Prior-sale ratios, years since (as of 2024-01-01), 4 % appreciation,
    flags before fills; fills from area median value and 999."""
    return FE.features_prior_sale(prior_sale_input(spark, sf)).select("property_id", *_PRIOR)


@query("q_rename_map", rounded(with_fx("""
SELECT propertyid, sumlivingareasqft AS living_sqft, lotsizesqft AS lot_sqft, sumbuildingsqft AS building_sqft,
  sumbasementsqft AS basement_sqft, basementfinishedsqft AS basement_finished_sqft,
  sumgaragesqft AS garage_sqft, sumgrossareasqft AS gross_sqft
FROM fx_assessor""", ["fx_assessor"]), ["living_sqft", "building_sqft", "gross_sqft"]))
def q_rename_map(spark, sf):
    """Physical -> logical names through a rename map (present columns only)."""
    d = FE.rename_columns(fx.assessor(spark, sf))
    return d.select("propertyid", *[v for v in FE.COLUMN_MAP.values()])


@query("q_features_building", rounded(with_fx("""
SELECT propertyid,
  CAST(basementfinishedsqft AS DOUBLE) / (sumbasementsqft + 1) AS basement_finished_ratio,
  CAST(COALESCE(sumgaragesqft > 500, false) AS TINYINT) AS has_large_garage,
  CAST(sumlivingareasqft AS DOUBLE) / (sumgrossareasqft + 1) AS living_to_gross_ratio
FROM fx_assessor""", ["fx_assessor"]), ["basement_finished_ratio", "living_to_gross_ratio"]))
def q_features_building(spark, sf):
    """Finished-basement ratio, garage > 500 sqft, living / gross area."""
    d = FE.features_building(FE.rename_columns(fx.assessor(spark, sf)))
    return d.select("propertyid", "basement_finished_ratio", "has_large_garage", "living_to_gross_ratio")


@query("q_features_area", rounded(with_fx("""
SELECT property_id, wealth_concentration_index, education_income_index, political_lean_strength, state_fips
FROM fx_extract""", ["fx_extract"]), ["wealth_concentration_index", "education_income_index",
                                       "political_lean_strength"]))
def q_features_area(spark, sf):
    """Area indices: income x population / 1e6, degree x income / 1e5, |gop - dem|, state FIPS."""
    return extract(spark, sf).select("property_id", "wealth_concentration_index", "education_income_index",
                                     "political_lean_strength", "state_fips")


_LISTING_FEATS = ["property_age", "effective_age", "total_baths", "gla_to_lot_ratio", "sqft_per_bedroom",
                  "has_garage", "has_pool", "has_fireplace", "hoa_monthly"]


@query("q_features_listing", rounded(with_fx("""
SELECT cc_list_id,
  CASE WHEN year_built IS NULL THEN NULL ELSE LEAST(GREATEST(2026 - year_built, 0), 200) END AS property_age,
  CASE WHEN effective_year_built IS NULL THEN NULL ELSE LEAST(GREATEST(2026 - effective_year_built, 0), 200) END
    AS effective_age,
  full_baths + 0.5::DOUBLE * COALESCE(half_baths, 0) AS total_baths,
  CAST(gla_sqft AS DOUBLE) / (lot_sqft + 1) AS gla_to_lot_ratio,
  CAST(gla_sqft AS DOUBLE) / (bedrooms + 1) AS sqft_per_bedroom,
  CAST(COALESCE(garage_spaces > 0, false) AS TINYINT) AS has_garage,
  CAST(pool_spa_types IS NOT NULL AS INTEGER) AS has_pool,
  CAST(COALESCE(fireplace_count > 0, false) AS TINYINT) AS has_fireplace,
  COALESCE(hoa_fee_amount, 0.0) AS hoa_monthly
FROM fx_listings""", ["fx_listings"]), ["total_baths", "gla_to_lot_ratio", "sqft_per_bedroom", "hoa_monthly"]))
def q_features_listing(spark, sf):
    """Listing features (base year 2026, ages clipped to 0..200)."""
    return FE.features_listing(fx.listings(spark, sf)).select("cc_list_id", *_LISTING_FEATS)


@query("q_router_tier", rounded(with_fx("""
SELECT cc_list_id, price, CASE WHEN price < 200000 THEN 0 WHEN price < 1000000 THEN 1 ELSE 2 END AS router_tier
FROM fx_listings WHERE price IS NOT NULL AND price >= 10000 AND price <= 10000000""", ["fx_listings"]), ["price"]))
def q_router_tier(spark, sf):
    """3-tier assignment (<200K, <1M, rest) after the 10K..10M target filter."""
    d = listing_input(spark, sf).filter(F.col("price").between(10000, 10000000))
    return d.select("cc_list_id", "price", tiers.router_tier(F.col("price")).alias("router_tier"))


_IMPUTE = ["effective_year_built", "half_baths", "gla_sqft", "fireplace_count", "hoa_fee_amount"]


def _impute_sql(where: str = "") -> str:
    cols = ",\n  ".join(
        f"COALESCE(CAST(l.{c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM src {where})) AS {c}" for c in _IMPUTE)
    return f"SELECT l.cc_list_id, {cols} FROM src l"


_SRC = ("src", "SELECT * FROM fx_listings WHERE price IS NOT NULL")


@query("q_impute_median", rounded(with_fx(_impute_sql(), ["fx_listings"], [_SRC]), _IMPUTE))
def q_impute_median(spark, sf):
    """Global median imputation (one aggregation pass, exact medians)."""
    d = listing_input(spark, sf)
    return FE.impute_median(d, _IMPUTE).select("cc_list_id", *_IMPUTE)


@query("q_impute_train", rounded(with_fx(
    _impute_sql(f"WHERE substr({_md5('cc_list_id')}, 1, 4) < '{TRAIN80}'").replace(
        "SELECT l.cc_list_id,", f"SELECT l.cc_list_id, substr({_md5('l.cc_list_id')}, 1, 4) < '{TRAIN80}' AS is_train,"),
    ["fx_listings"], [_SRC]), _IMPUTE))
def q_impute_train(spark, sf):
    """Medians of the train rows only, applied to train and test."""
    d = listing_input(spark, sf).withColumn("is_train", FE.hash_split(F.col("cc_list_id"), 0.8))
    return FE.impute_train(d, F.col("is_train"), _IMPUTE).select("cc_list_id", "is_train", *_IMPUTE)


_CATS = ["state", "city", "subdivision", "property_sub_type"]


def _label_sql() -> str:
    parts, ctes = [], []
    for c in _CATS:
        ctes.append((f"lv_{c}", f"""
SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (
  SELECT DISTINCT COALESCE({c}, 'Unknown') AS v FROM src UNION SELECT 'Unknown') t"""))
        parts.append(f"""
SELECT s.cc_list_id, '{c}' AS feature, lv.code FROM src s JOIN lv_{c} lv ON COALESCE(s.{c}, 'Unknown') = lv.v
WHERE (SELECT COUNT(DISTINCT COALESCE({c}, 'Unknown')) FROM src) < 100""")
    return with_fx("\nUNION ALL".join(parts), ["fx_listings"], [_SRC] + ctes)


@query("q_label_encode", _label_sql())
def q_label_encode(spark, sf):
    """Label codes (sorted labels, NULL -> 'Unknown', 'Unknown' reserved);
    columns with >= 100 levels dropped.  Shown in long form (id, feature, code)."""
    d = listing_input(spark, sf).select("cc_list_id", *_CATS)
    enc = FE.label_encode(d, _CATS)
    kept = [c for c in _CATS if c in enc.columns]
    if not kept:
        return spark.createDataFrame([], "cc_list_id bigint, feature string, code int")
    return enc.unpivot("cc_list_id", kept, "feature", "code")


@query("q_hash_split", with_fx(f"""
SELECT property_id, substr({_md5('property_id')}, 1, 4) < '{TRAIN80}' AS is_train_80,
  substr({_md5('property_id')}, 1, 4) < '{TRAIN70}' AS is_train_70
FROM fx_extract""", ["fx_extract"]))
def q_hash_split(spark, sf):
    """80/20 and 70/30 splits on md5(id|42): repeatable, partition-independent."""
    return extract(spark, sf).select(
        "property_id", FE.hash_split(F.col("property_id"), 0.8).alias("is_train_80"),
        FE.hash_split(F.col("property_id"), 0.7).alias("is_train_70"))


@query("q_split_complement", with_fx(f"""
SELECT property_id FROM fx_extract WHERE NOT (substr({_md5('property_id')}, 1, 4) < '{TRAIN70}')""",
                                     ["fx_extract"]))
def q_split_complement(spark, sf):
    """Test = all minus train (70/30): the negated bucket predicate, no anti join."""
    return extract(spark, sf).filter(~FE.hash_split(F.col("property_id"), 0.7)).select("property_id")


@query("q_stratified_split", with_fx(f"""
SELECT cc_list_id, router_tier,
  ROW_NUMBER() OVER (PARTITION BY router_tier ORDER BY {_md5('cc_list_id')}, cc_list_id)
    <= CEIL(0.8::DOUBLE * COUNT(*) OVER (PARTITION BY router_tier)) AS is_train
FROM (SELECT cc_list_id, CASE WHEN price < 200000 THEN 0 WHEN price < 1000000 THEN 1 ELSE 2 END AS router_tier
      FROM fx_listings WHERE price IS NOT NULL AND price >= 10000 AND price <= 10000000) t""", ["fx_listings"]))
def q_stratified_split(spark, sf):
    """Exact 80/20 per router tier (histogram boundary, no whole-tier sort)."""
    d = (listing_input(spark, sf).filter(F.col("price").between(10000, 10000000))
         .select("cc_list_id", tiers.router_tier(F.col("price")).alias("router_tier")))
    return FE.stratified_split(d, "router_tier", "cc_list_id", 0.8).select("cc_list_id", "router_tier", "is_train")


@query("q_cluster_target_stats", rounded(with_fx(f"""
SELECT e.property_id, e.geo_cluster,
  COALESCE(s.cluster_avg_price, m.med) AS cluster_avg_price,
  COALESCE(s.cluster_med_price, m.med) AS cluster_med_price
FROM e LEFT JOIN (SELECT geo_cluster, AVG(sale_price) AS cluster_avg_price,
                         quantile_cont(sale_price, 0.5) AS cluster_med_price
                  FROM e WHERE is_train GROUP BY geo_cluster) s USING (geo_cluster),
     (SELECT quantile_cont(sale_price, 0.5) AS med FROM e WHERE is_train) m""", ["fx_extract"],
    [("e", f"""SELECT property_id, sale_price, CAST(floor(latitude) AS BIGINT) % 8 AS geo_cluster,
                 substr({_md5('property_id')}, 1, 4) < '{TRAIN80}' AS is_train FROM fx_extract""")]),
    ["cluster_avg_price", "cluster_med_price"]))
def q_cluster_target_stats(spark, sf):
    """Cluster mean / median price on train rows only, broadcast back, train
    median for clusters without train rows (clusters: a fixed lat grid)."""
    e = extract(spark, sf).select("property_id", "sale_price",
                                  (F.floor("latitude") % 8).alias("geo_cluster"),
                                  FE.hash_split(F.col("property_id"), 0.8).alias("is_train"))
    return FE.cluster_target_stats(e, F.col("is_train"), "sale_price").select(
        "property_id", "geo_cluster", "cluster_avg_price", "cluster_med_price")


@query("q_geo_clusters")
def q_geo_clusters(spark, sf):
    """k-means (k=8) on latitude/longitude; invalid rows to cluster 0."""
    e = extract(spark, sf).select("property_id", "latitude", "longitude")
    return FE.geo_clusters(e).select("property_id", "geo_cluster")


OUTLIER_CTES = [
        ("t0", f"""SELECT property_id, lot_sqft, year_built,
                 sale_price / (living_sqft + 1) AS ppsf, living_sqft / (sale_price + 1) AS spd,
                 {'CASE ' + ' '.join(f"WHEN sale_price >= {lo} AND sale_price < {hi} THEN '{n}'" if hi != float('inf')
                                     else f"WHEN sale_price >= {lo} THEN '{n}'" for n, lo, hi in tiers.PRICE_TIERS_POOLED)
                    + " ELSE 'ultra_high' END"} AS price_tier FROM fx_extract"""),
        ("tg", "SELECT * FROM t0 WHERE price_tier IN ('very_low', 'ultra_high')"),
        ("q1", "SELECT price_tier, quantile_cont(ppsf, 0.05) AS lo, quantile_cont(ppsf, 0.95) AS hi FROM tg GROUP BY 1"),
        ("s1", "SELECT tg.* FROM tg JOIN q1 USING (price_tier) WHERE ppsf >= lo AND ppsf <= hi"),
        ("q2", "SELECT price_tier, quantile_cont(spd, 0.95) AS s95 FROM s1 GROUP BY 1"),
        ("s2", "SELECT s1.* FROM s1 JOIN q2 USING (price_tier) WHERE spd <= s95"),
        ("q3", "SELECT price_tier, quantile_cont(lot_sqft, 0.98) AS l98 FROM s2 GROUP BY 1"),
        ("s3", "SELECT s2.* FROM s2 JOIN q3 USING (price_tier) WHERE lot_sqft <= l98"),
        ("s4", "SELECT * FROM s3 WHERE year_built >= 1900 AND year_built <= 2025"),
    ]


@query("q_outlier_filter", with_fx(f"""
SELECT property_id, price_tier FROM s4
UNION ALL SELECT property_id, price_tier FROM t0 WHERE price_tier NOT IN ('very_low', 'ultra_high')""",
    ["fx_extract"], OUTLIER_CTES))
def q_outlier_filter(spark, sf):
    """Sequential percentile filter on very_low / ultra_high (pooled tiers)."""
    e = extract(spark, sf).withColumn("price_tier", tiers.price_tier(F.col("sale_price"), tiers.PRICE_TIERS_POOLED))
    kept, _ = FE.outlier_filter(e, "sale_price")
    return kept.select("property_id", "price_tier")
