"""Queries of the SQL-extract family (survey 2.1-2.3, 2.5-2.7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import Window

from propval.functions import tiers
from propval.operators import extract as X
from propval.plans.oracle_fixtures import BASE_DOUBLES, CENSUS_DOUBLES, with_fx
from propval.plans.registry import query, rounded
from propval.sources import fixtures as fx
from propval.sources.io import write_bucketed


def census(spark, sf):
    return X.census_tract_rollup(fx.cbg_tables(spark, sf))


def base(spark, sf, states=X.TOP10_STATES):
    return X.property_base(fx.assessor(spark, sf), census(spark, sf), fx.votes(spark, sf), states=states)


def extract(spark, sf):
    """The modelling extract: every state, quality and range filters."""
    return base(spark, sf, states=None)


@query("q_tract_rollup", rounded(with_fx("SELECT * FROM fx_census", ["fx_census"]), CENSUS_DOUBLES))
def q_tract_rollup(spark, sf):
    """Block groups -> tracts: 7-way left join on the block-group key, then group."""
    return census(spark, sf)


@query("q_property_base", rounded(with_fx("SELECT * FROM fx_base", ["fx_base"]), BASE_DOUBLES))
def q_property_base(spark, sf):
    """Aliased projection of assessor + census + votes for the ten states."""
    return base(spark, sf)


@query("q_quality_filter", with_fx("""
SELECT propertyid AS property_id, situsstate AS state, currentsalesprice AS sale_price
FROM fx_assessor p WHERE """ + """
  p.currentsalesprice IS NOT NULL AND p.sumlivingareasqft IS NOT NULL AND p.lotsizesqft IS NOT NULL
  AND p.situslatitude IS NOT NULL AND p.situslongitude IS NOT NULL
  AND p.currentsalesprice BETWEEN 10000 AND 100000000
  AND p.sumlivingareasqft > 0 AND p.lotsizesqft > 0 AND p.bedrooms > 0""", ["fx_assessor"]))
def q_quality_filter(spark, sf):
    """Not-null and range/positivity filters on the raw assessor rows."""
    return X.quality_filter(fx.assessor(spark, sf)).select(
        F.col("propertyid").alias("property_id"), F.col("situsstate").alias("state"),
        F.col("currentsalesprice").alias("sale_price"))


@query("q_county_join", with_fx("""
SELECT p.propertyid AS property_id,
  LEFT(LPAD(TRIM(CAST(p.fips AS STRING)), 5, '0'), 5) AS county_key,
  v.county_name AS county_name, v.votes_gop AS votes_gop,
  u.county_name AS county_name_unpadded
FROM fx_assessor p
LEFT JOIN fx_votes v
  ON LEFT(LPAD(TRIM(CAST(p.fips AS STRING)), 5, '0'), 5) = LPAD(TRIM(CAST(v.county_fips AS STRING)), 5, '0')
LEFT JOIN fx_votes u
  ON LEFT(CAST(p.fips AS STRING), 5) = CAST(u.county_fips AS STRING)""", ["fx_assessor", "fx_votes"]))
def q_county_join(spark, sf):
    """Normalised county key (padded both sides) next to the lossy unpadded key."""
    from propval.functions.keys import county_fips
    a = fx.assessor(spark, sf).select("propertyid", "fips")
    v = fx.votes(spark, sf)
    padded = X.county_join(a, v, pad=True).select(
        "propertyid", "fips", county_fips(F.col("fips")).alias("county_key"),
        F.col("v.county_name").alias("name"), F.col("v.votes_gop").alias("gop"))
    return X.county_join(padded, v, pad=False).select(
        F.col("propertyid").alias("property_id"), "county_key", F.col("name").alias("county_name"),
        F.col("gop").alias("votes_gop"), F.col("v.county_name").alias("county_name_unpadded"))


def _tier_case(col: str, pooled: bool = False) -> str:
    t = tiers.PRICE_TIERS_POOLED if pooled else tiers.PRICE_TIERS
    parts = []
    for name, lo, hi in t:
        if hi == float("inf"):
            parts.append(f"WHEN {col} >= {lo} THEN '{name}'")
        else:
            parts.append(f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{name}'")
    return "CASE " + " ".join(parts) + " ELSE 'ultra_high' END"


@query("q_price_tier", rounded(with_fx(f"""
SELECT property_id, sale_price, {_tier_case('sale_price')} AS price_tier,
  {_tier_case('sale_price', True)} AS price_tier_pooled
FROM fx_extract""", ["fx_extract"]), ["sale_price"]))
def q_price_tier(spark, sf):
    """8-tier assignment, [low, high) with 'ultra_high' default; both top cuts."""
    p = F.col("sale_price")
    return extract(spark, sf).select(
        "property_id", "sale_price", tiers.price_tier(p).alias("price_tier"),
        tiers.price_tier(p, tiers.PRICE_TIERS_POOLED).alias("price_tier_pooled"))


@query("q_tier_distribution", rounded(with_fx(f"""
SELECT price_tier, COUNT(*) AS n, 100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER () AS share_pct,
  MIN(sale_price) AS min_price, MAX(sale_price) AS max_price
FROM (SELECT sale_price, {_tier_case('sale_price')} AS price_tier FROM fx_extract) t
GROUP BY price_tier""", ["fx_extract"]), ["share_pct", "min_price", "max_price"]))
def q_tier_distribution(spark, sf):
    """Count, share, min and max price per tier."""
    from propval.operators.metrics import tier_distribution
    return tier_distribution(extract(spark, sf), "sale_price")


from propval.plans.oracle_fixtures import ASSESSOR_DOUBLES, PAD5  # noqa: E402

_P5 = PAD5.format("p.fips")
_V5 = PAD5.format("v.county_fips")
_TRACT_JOIN = f"LEFT JOIN fx_census c ON {_P5} || TRIM(p.situscensustract) = c.census_tract"
_VOTE_JOIN = f"LEFT JOIN fx_votes v ON {_P5} = LPAD(TRIM(CAST(v.county_fips AS STRING)), 5, '0')"
_VOTE_DOUBLES = ["per_gop", "per_dem", "per_point_diff"]


@query("q_star_join", rounded(with_fx(f"""
SELECT p.*, LEFT({_P5}, 2) AS state_fips, {_P5} AS county_fips, c.*,
  v.* EXCLUDE (county_fips), v.county_fips AS v_county_fips
FROM fx_assessor p {_TRACT_JOIN} {_VOTE_JOIN}""", ["fx_assessor", "fx_census", "fx_votes"]),
    ASSESSOR_DOUBLES + CENSUS_DOUBLES + _VOTE_DOUBLES))
def q_star_join(spark, sf):
    """``p.*, c.*, v.*`` with explicit prefixing of colliding names."""
    return X.star_join(fx.assessor(spark, sf), census(spark, sf), fx.votes(spark, sf))


@query("q_price_bounds", rounded(with_fx("""
SELECT property_id, sale_price FROM fx_extract WHERE sale_price >= 100000""", ["fx_extract"]), ["sale_price"]))
def q_price_bounds(spark, sf):
    """Price floor of the stratified workflow (>= 100000)."""
    return X.price_bounds(extract(spark, sf), "sale_price", low=100000).select("property_id", "sale_price")


# Fixed parameters of the region predicate on the stand-in codes
# (nation 10 = 'nc', 2 = 'ny', 6 = 'oh').
REGION_SPEC = [("nc", ["10003", "10007", "10011", "10015", "10019"], None),
               ("ny", None, ["02000", "02005", "02010", "02015"]),
               ("oh", None, None)]


@query("q_region_filter", with_fx(f"""
SELECT p.propertyid AS property_id, p.situsstate AS state, {_P5} AS county_key
FROM fx_assessor p
WHERE (p.situsstate = 'nc' AND {_P5} IN ('10003', '10007', '10011', '10015', '10019'))
   OR (p.situsstate = 'ny' AND {_P5} NOT IN ('02000', '02005', '02010', '02015'))
   OR (p.situsstate = 'oh')""", ["fx_assessor"]))
def q_region_filter(spark, sf):
    """OR of (state AND county IN / NOT IN) clauses."""
    from propval.functions.keys import county_fips
    return X.region_filter(fx.assessor(spark, sf), REGION_SPEC).select(
        F.col("propertyid").alias("property_id"), F.col("situsstate").alias("state"),
        county_fips(F.col("fips")).alias("county_key"))


@query("q_assessed_pairs", rounded(with_fx("""
SELECT propertyid AS property_id, assdtotalvalue AS assessed_total_value, currentsalesprice AS price
FROM fx_assessor
WHERE assessedyear IN (2025, 2026) AND assdtotalvalue IS NOT NULL AND currentsalesprice IS NOT NULL""",
    ["fx_assessor"]), ["assessed_total_value", "price"]))
def q_assessed_pairs(spark, sf):
    """(assessed value, sale price) pairs for assessment years 2025 and 2026."""
    a = fx.assessor(spark, sf)
    return (a.filter(F.col("assessedyear").isin(2025, 2026) & F.col("assdtotalvalue").isNotNull()
                     & F.col("currentsalesprice").isNotNull())
             .select(F.col("propertyid").alias("property_id"),
                     F.col("assdtotalvalue").alias("assessed_total_value"),
                     F.col("currentsalesprice").alias("price")))


@query("q_lateral_alias", with_fx(f"""
SELECT propertyid AS property_id, state_fips, county_fips FROM (
  SELECT p.propertyid, LEFT({_P5}, 2) AS state_fips, {_P5} AS county_fips FROM fx_assessor p) t
WHERE state_fips IN ('10', '02', '06', '20', '18')
  AND NOT (state_fips = '02' AND county_fips IN ('02000', '02005', '02010', '02015'))""", ["fx_assessor"]))
def q_lateral_alias(spark, sf):
    """Filter on ``state_fips`` / ``county_fips`` computed in the same select."""
    d = X.state_fips_filter(fx.assessor(spark, sf), ["10", "02", "06", "20", "18"],
                            ["02000", "02005", "02010", "02015"], exclude_state="02")
    return d.select(F.col("propertyid").alias("property_id"), "state_fips", "county_fips")


@query("q_amenity_flags", with_fx("""
SELECT propertyid AS property_id, COALESCE(effectiveyearbuilt, yearbuilt) AS year_built_final,
  CASE WHEN fireplacecode IS NOT NULL THEN 1 ELSE 0 END AS has_fireplace,
  CASE WHEN poolcode IS NOT NULL AND poolcode > 0 THEN 1 ELSE 0 END AS has_pool,
  CASE WHEN airconditioningcode IS NOT NULL AND airconditioningcode > 0 THEN 1 ELSE 0 END AS has_ac,
  CASE WHEN basementcode IS NOT NULL THEN 1 ELSE 0 END AS has_basement,
  CASE WHEN watercode IS NOT NULL AND watercode > 0 THEN 1 ELSE 0 END AS has_water_feature
FROM fx_assessor""", ["fx_assessor"]))
def q_amenity_flags(spark, sf):
    """Presence flags (``CASE WHEN code IS NOT NULL [AND code > 0]``) and effective year."""
    return fx.assessor(spark, sf).select(F.col("propertyid").alias("property_id"), *X.amenity_flags())


@query("q_typed_nulls", with_fx("""
SELECT census_tract, population_below_poverty, poverty_rate FROM fx_census""", ["fx_census"]))
def q_typed_nulls(spark, sf):
    """Typed NULL placeholders next to the tract key."""
    return census(spark, sf).select("census_tract", "population_below_poverty", "poverty_rate")


# Leaky and id columns dropped before modelling.
LEAKY_COLUMNS = ["assessed_year", "assessed_total_value", "tax_amount", "tax_amount_frequency",
                 "market_ppsf", "most_recent_sale", "trended_prior_sale", "concessions_amount",
                 "mls_days_on_market", "mls_cumulative_days_on_market"]
ID_COLUMNS = ["a_date", "fips_county_cd"]


@query("q_drop_leaky", rounded(with_fx(f"""
SELECT * EXCLUDE ({', '.join(c for c in LEAKY_COLUMNS + ID_COLUMNS if c in (
    'assessed_year', 'assessed_total_value', 'tax_amount', 'most_recent_sale', 'mls_days_on_market',
    'a_date', 'fips_county_cd'))})
FROM fx_listings WHERE price IS NOT NULL""", ["fx_listings"]),
    ["price", "latitude", "longitude", "gla_sqft", "lot_sqft", "hoa_fee_amount"]))
def q_drop_leaky(spark, sf):
    """Drop leaky / id columns if present (tolerant) and rows without target."""
    from propval.operators.features import drop_leaky
    return drop_leaky(fx.listings(spark, sf), LEAKY_COLUMNS + ID_COLUMNS, "price")


_RED_DOUBLES = ["pct_bachelors_degree", "median_home_value", "median_gross_rent", "pct_owner_occupied",
                "vacancy_rate"]


@query("q_redundant_join", rounded(with_fx("""
SELECT LEFT(a.census_block_group, 11) AS census_tract,
  CASE WHEN SUM(a.b15002e1) > 0 THEN 100.0::DOUBLE * CAST(SUM(a.b15002e15 + a.b15002e32) AS DOUBLE)
       / CAST(SUM(a.b15002e1) AS DOUBLE) END AS pct_bachelors_degree,
  AVG(housing_value.b25077e1) AS median_home_value,
  AVG(rent.b25064e1) AS median_gross_rent,
  CASE WHEN SUM(tenure.b25003e1) > 0 THEN 100.0::DOUBLE * CAST(SUM(tenure.b25003e2) AS DOUBLE)
       / CAST(SUM(tenure.b25003e1) AS DOUBLE) END AS pct_owner_occupied,
  CASE WHEN SUM(occupancy.b25002e2) + SUM(occupancy.b25002e3) > 0
       THEN 100.0::DOUBLE * CAST(SUM(occupancy.b25002e3) AS DOUBLE)
       / CAST(SUM(occupancy.b25002e2) + SUM(occupancy.b25002e3) AS DOUBLE) END AS vacancy_rate
FROM fx_b15 a
LEFT JOIN fx_b25 housing_value ON a.census_block_group = housing_value.census_block_group
LEFT JOIN fx_b25 rent ON a.census_block_group = rent.census_block_group
LEFT JOIN fx_b25 tenure ON a.census_block_group = tenure.census_block_group
LEFT JOIN fx_b25 occupancy ON a.census_block_group = occupancy.census_block_group
WHERE LEFT(a.census_block_group, 2) IN ('10', '02', '06')
GROUP BY 1""", ["fx_b15", "fx_b25"]), _RED_DOUBLES))
def q_redundant_join(spark, sf):
    """One table joined under four aliases equals one join (unique key); the
    state prefix list is a ``startswith`` pushed below the joins."""
    r = X.census_tract_rollup(fx.cbg_tables(spark, sf), state_prefixes=["10", "02", "06"], sum_of_sums=False)
    return r.select("census_tract", *_RED_DOUBLES)


@query("q_null_sum_variants", with_fx("""
SELECT LEFT(census_block_group, 11) AS census_tract,
  CAST(SUM(b15002e15 + b15002e32) AS BIGINT) AS sum_of_pairs,
  CAST(SUM(b15002e15) + SUM(b15002e32) AS BIGINT) AS sum_of_sums
FROM fx_b15 GROUP BY 1""", ["fx_b15"]))
def q_null_sum_variants(spark, sf):
    """``SUM(a+b)`` (drops rows where either is NULL) vs ``SUM(a)+SUM(b)``."""
    from propval.functions.keys import block_group_tract
    b15 = fx.cbg_tables(spark, sf)["b15"]
    return b15.groupBy(block_group_tract(F.col("census_block_group")).alias("census_tract")).agg(
        F.sum(F.col("b15002e15") + F.col("b15002e32")).alias("sum_of_pairs"),
        (F.sum("b15002e15") + F.sum("b15002e32")).alias("sum_of_sums"))


@query("q_tract_concat_join", with_fx("""
SELECT p.propertyid AS property_id, c.census_tract AS matched_tract, c.total_population
FROM fx_assessor p
LEFT JOIN fx_census c ON LEFT(CAST(p.fips AS STRING), 5) || p.situscensustract = c.census_tract""",
    ["fx_assessor", "fx_census"]))
def q_tract_concat_join(spark, sf):
    """``LEFT(FIPS, 5) || tract = census_tract`` as written (unpadded)."""
    j = X.tract_concat_join(fx.assessor(spark, sf), census(spark, sf), pad=False)
    return j.select(F.col("propertyid").alias("property_id"), F.col("c.census_tract").alias("matched_tract"),
                    F.col("c.total_population").alias("total_population"))


@query("q_null_rejecting_join", rounded(with_fx(f"""
SELECT i.property_id, p.currentsalesprice AS sale_price, p.situsstate AS state,
  c.total_population, v.county_name
FROM (SELECT DISTINCT property_id FROM fx_image_tags) i
LEFT JOIN fx_assessor p ON i.property_id = p.propertyid
{_TRACT_JOIN} {_VOTE_JOIN}
WHERE LOWER(p.situsstate) = 'nc' AND p.currentsalesprice IS NOT NULL AND p.sumlivingareasqft IS NOT NULL
  AND p.lotsizesqft IS NOT NULL AND p.situslatitude IS NOT NULL AND p.situslongitude IS NOT NULL""",
    ["fx_image_tags", "fx_assessor", "fx_census", "fx_votes"]), ["sale_price"]))
def q_null_rejecting_join(spark, sf):
    """Image LEFT JOIN assessor filtered on assessor columns: Catalyst turns
    the outer join into an inner join (EliminateOuterJoin)."""
    from propval.functions.keys import county_fips, tract_key
    img = fx.image_tags(spark, sf).select("property_id").distinct()
    p = fx.assessor(spark, sf)
    c = census(spark, sf).select("census_tract", "total_population")
    v = fx.votes(spark, sf).select(county_fips(F.col("county_fips")).alias("_vk"), "county_name")
    j = (img.join(p, img.property_id == p.propertyid, "left")
            .join(c, tract_key(F.col("fips"), F.col("situscensustract")) == c.census_tract, "left")
            .join(v, county_fips(F.col("fips")) == v._vk, "left"))
    j = X.quality_filter(j.filter(F.lower("situsstate") == "nc"), ranges=False)
    return j.select("property_id", F.col("currentsalesprice").alias("sale_price"),
                    F.col("situsstate").alias("state"), "total_population", "county_name")


_LIST_IMG = f"""
SELECT m.cc_list_id, m.price, e.gran_c, e.high_c
FROM fx_listings m LEFT JOIN (
  SELECT property_id, AVG(granular_condition_num) AS gran_c, AVG(high_condition_num) AS high_c
  FROM fx_image_tags GROUP BY property_id) e ON m.cc_list_id = e.property_id"""


def _listing_image(spark, sf):
    from propval.operators.tags import condition_means_long
    e = condition_means_long(fx.image_tags(spark, sf)).select("property_id", "gran_c", "high_c")
    m = fx.listings(spark, sf).select("cc_list_id", "price")
    return m.join(e, m.cc_list_id == e.property_id, "left").select("cc_list_id", "price", "gran_c", "high_c")


@query("q_listing_image_join", rounded(with_fx(_LIST_IMG, ["fx_listings", "fx_image_tags"]),
                                       ["price", "gran_c", "high_c"]))
def q_listing_image_join(spark, sf):
    """Listings LEFT JOIN image conditions on the listing id."""
    return _listing_image(spark, sf)


@query("q_limit_preview", rounded(with_fx(_LIST_IMG + "\nORDER BY m.cc_list_id LIMIT 100",
                                          ["fx_listings", "fx_image_tags"]), ["price", "gran_c", "high_c"]))
def q_limit_preview(spark, sf):
    """LIMIT 100 preview, made deterministic by ordering on the key first."""
    return _listing_image(spark, sf).orderBy("cc_list_id").limit(100)


_MD5 = "md5(CAST(property_id AS STRING) || '|42')"


@query("q_sample_per_state", rounded(with_fx(f"""
SELECT property_id, state_fips, sale_price FROM fx_base
QUALIFY ROW_NUMBER() OVER (PARTITION BY state_fips ORDER BY {_MD5}, property_id) <= 1000""", ["fx_base"]),
    ["sale_price"]))
def q_sample_per_state(spark, sf):
    """1000 rows per state, repeatable hash order (QUALIFY as window + filter)."""
    return X.sample_per_group(base(spark, sf), "state_fips", 1000, "property_id") \
            .select("property_id", "state_fips", "sale_price")


@query("q_stratified_extract", rounded(with_fx(f"""
SELECT * FROM (
  (SELECT * FROM fx_base QUALIFY ROW_NUMBER() OVER (PARTITION BY state_fips ORDER BY {_MD5}, property_id) <= 1000)
  UNION
  (SELECT * FROM fx_base WHERE sale_price > 800000)) u
ORDER BY sale_price DESC, property_id""", ["fx_base"]), BASE_DOUBLES))
def q_stratified_extract(spark, sf):
    """Random sample per state UNION every property above 800K, price desc."""
    return X.stratified_extract(fx.assessor(spark, sf), census(spark, sf), fx.votes(spark, sf))


@query("q_id_bridge", with_fx("""
SELECT DISTINCT m.mls_id, a.assessor_id
FROM fx_address f, UNNEST(f.mls_ids) AS m(mls_id), UNNEST(f.assessor_ids) AS a(assessor_id)
ORDER BY assessor_id, mls_id""", ["fx_address"]))
def q_id_bridge(spark, sf):
    """Every (mls_id, assessor_id) of one address: two explodes + distinct."""
    return X.id_bridge(fx.address(spark, sf))


def stored_bridge(spark, sf):
    """The bridge as a table of its own, bucketed by listing id."""
    return write_bucketed(X.id_bridge(fx.address(spark, sf)), "propval_id_bridge_" + uuid.uuid4().hex[:12], ["mls_id"])


@query("q_bridge_listings", rounded(with_fx("""
SELECT b.assessor_id, COUNT(*) AS n_listings, COUNT(l.price) AS n_priced, MIN(l.price) AS min_price, MAX(l.price) AS max_price,
  MAX(l.a_date) AS last_date
FROM (SELECT DISTINCT m.mls_id, a.assessor_id
      FROM fx_address f, UNNEST(f.mls_ids) AS m(mls_id), UNNEST(f.assessor_ids) AS a(assessor_id)) b
JOIN fx_listings l ON b.mls_id = CAST(l.cc_list_id AS VARCHAR)
GROUP BY b.assessor_id""", ["fx_address", "fx_listings"]), ["min_price", "max_price"]))
def q_bridge_listings(spark, sf):
    """Listings of each property through the stored bridge table."""
    return X.listings_by_property(stored_bridge(spark, sf), fx.listings(spark, sf).select("cc_list_id", "price", "a_date"))
