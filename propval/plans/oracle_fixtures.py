"""DuckDB text of the fixture views (mirror of ``propval.sources.fixtures``).

The oracle queries run in DuckDB over the same driver tables.  Each entry is
``name -> (sql, dependencies)``; :func:`with_fx` prepends the needed views as
CTEs in dependency order.
"""

from __future__ import annotations

from propval.sources.fixtures import STATE_CODES, ZONING_CODES
from propval.operators.extract import TOP10_STATES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


FX: dict[str, tuple[str, list[str]]] = {}

FX["fx_line_totals"] = ("""
SELECT l_orderkey, SUM(l_quantity) AS _qty,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS _ext_cents,
       COUNT(*) AS _n, COUNT(DISTINCT l_returnflag) AS _nrf
FROM lineitem GROUP BY l_orderkey""", [])

FX["fx_assessor"] = (f"""
SELECT o.o_orderkey AS propertyid,
  ROUND(o.o_totalprice * 4, 2) AS currentsalesprice,
  CAST(o.o_orderdate AS DATE) AS currentsalerecordingdate,
  1900 + o.o_orderkey % 126 AS yearbuilt,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 1950 + o.o_orderkey % 70 END AS effectiveyearbuilt,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE 25.0 + CAST(o.o_custkey % 2000 AS DOUBLE) / 100 END AS situslatitude,
  -70.0 - CAST(o.o_custkey % 5000 AS DOUBLE) / 100 AS situslongitude,
  CASE WHEN o.o_orderkey % 11 = 0 THEN UPPER(({_list(STATE_CODES)})[c.c_nationkey + 1])
       ELSE ({_list(STATE_CODES)})[c.c_nationkey + 1] END AS situsstate,
  'city_' || CAST(o.o_custkey % 30 AS STRING) AS situscity,
  LPAD(CAST(o.o_custkey % 100000 AS STRING), 5, '0') AS situszip5,
  CAST(c.c_nationkey AS BIGINT) * 1000 + o.o_custkey % 20 AS fips,
  LPAD(CAST(o.o_custkey % 50 AS STRING), 6, '0') AS situscensustract,
  l._qty * 20 AS sumlivingareasqft,
  l._ext_cents // 1000 + 1 AS lotsizesqft,
  ROUND((l._ext_cents // 1000 + 1) / 43560, 4) AS lotsizeacres,
  l._n AS bedrooms,
  l._nrf AS bathfull,
  CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE o.o_orderkey % 3 END AS bathspartialnbr,
  l._n + 3 AS totalrooms,
  o.o_orderkey % 4 AS garageparkingnbr,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE o.o_orderkey % 3 END AS fireplacecode,
  o.o_custkey % 5 + 1 AS buildingqualitycode,
  o.o_orderkey % 5 + 1 AS buildingconditioncode,
  o.o_custkey % 9 AS stylecode,
  CASE WHEN o.o_orderkey % 5 = 0 THEN o.o_orderkey % 3 END AS poolcode,
  o.o_orderkey % 3 + 1 AS storiesnbrcode,
  CASE WHEN o.o_orderkey % 2 = 0 THEN o.o_orderkey % 4 END AS airconditioningcode,
  CASE WHEN o.o_custkey % 3 = 0 THEN 1 END AS basementcode,
  CASE WHEN o.o_custkey % 3 = 0 THEN (o.o_orderkey % 10) * 50 END AS basementfinishedsqft,
  CASE WHEN o.o_orderkey % 10 = 0 THEN o.o_orderkey % 2 END AS watercode,
  ROUND(o.o_totalprice * 3, 0) AS assdtotalvalue,
  ROUND(o.o_totalprice, 0) AS assdlandvalue,
  ROUND(o.o_totalprice * 3, 0) - ROUND(o.o_totalprice, 0) AS assdimprovementvalue,
  ROUND(o.o_totalprice * 1.1, 0) AS marketvalueland,
  ROUND(o.o_totalprice * 2.2, 0) AS marketvalueimprovement,
  CAST(NULL AS STRING) AS topographycode,
  o.o_orderkey % 7 AS siteinfluencecode,
  o.o_custkey % 11 AS exteriorwallscode,
  CAST(NULL AS STRING) AS roofcovercode,
  o.o_orderkey % 2 = 1 AS owneroccupied,
  CASE WHEN o.o_orderkey % 5 = 1 THEN NULL ELSE ROUND(o.o_totalprice * 3, 2) END AS prevsalesprice,
  CASE WHEN o.o_orderkey % 5 = 1 THEN NULL
       ELSE CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 3000 AS INTEGER) END AS prevsalerecordingdate,
  'sub_' || CAST(o.o_custkey % 40 AS STRING) AS subdivisionname,
  ({_list(ZONING_CODES)})[o.o_orderkey % 4 + 1] AS zoning,
  2023 + o.o_orderkey % 4 AS assessedyear,
  l._qty * 22 AS sumbuildingsqft,
  CASE WHEN o.o_custkey % 3 = 0 THEN (o.o_orderkey % 10) * 80 END AS sumbasementsqft,
  (o.o_orderkey % 4) * 250 AS sumgaragesqft,
  l._qty * 25 AS sumgrossareasqft
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN fx_line_totals l ON o.o_orderkey = l.l_orderkey""", ["fx_line_totals"])

FX["fx_customer_cbg"] = ("""
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment,
  LPAD(CAST(c_nationkey AS STRING), 2, '0') || LPAD(CAST(c_custkey % 20 AS STRING), 3, '0')
  || LPAD(CAST(c_custkey % 50 AS STRING), 6, '0') || CAST(c_custkey % 3 AS STRING) AS census_block_group
FROM customer""", [])

_CBG = "fx_customer_cbg"
FX["fx_b15"] = (f"""
SELECT census_block_group,
  CAST(SUM(c_custkey % 997 + 50) AS BIGINT) AS b15002e1,
  CAST(SUM(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 13 END) AS BIGINT) AS b15002e15,
  CAST(SUM(c_custkey % 17) AS BIGINT) AS b15002e32
FROM {_CBG} GROUP BY census_block_group""", [_CBG])
FX["fx_b03"] = (f"""
SELECT census_block_group,
  CAST(SUM(c_custkey % 500 + 100) AS BIGINT) AS b03002e1,
  CAST(SUM(c_custkey % 300) AS BIGINT) AS b03002e3
FROM {_CBG} WHERE c_custkey % 11 != 5 GROUP BY census_block_group""", [_CBG])
FX["fx_b20"] = (f"""
SELECT census_block_group,
  AVG(c_acctbal + 30000) AS b20002e1,
  AVG(c_acctbal * 1.2 + 30000) AS b20002e2,
  AVG(c_acctbal * 0.8 + 25000) AS b20002e3
FROM {_CBG} WHERE c_custkey % 13 != 3 GROUP BY census_block_group""", [_CBG])
FX["fx_b19"] = (f"""
SELECT census_block_group, AVG(c_acctbal * 10 + 60000) AS b19013e1
FROM {_CBG} GROUP BY census_block_group""", [_CBG])
FX["fx_b25"] = (f"""
SELECT census_block_group,
  AVG(c_acctbal * 40 + 300000) AS b25077e1,
  AVG(c_acctbal / 10 + 1200) AS b25064e1,
  CAST(SUM(c_custkey % 200 + 20) AS BIGINT) AS b25003e1,
  CAST(SUM(c_custkey % 20) AS BIGINT) AS b25003e2,
  CAST(SUM(c_custkey % 200 + 20 - c_custkey % 20) AS BIGINT) AS b25003e3,
  CAST(SUM(c_custkey % 180 + 10) AS BIGINT) AS b25002e2,
  CAST(SUM(c_custkey % 9) AS BIGINT) AS b25002e3
FROM {_CBG} WHERE c_custkey % 17 != 2 GROUP BY census_block_group""", [_CBG])
FX["fx_b01"] = (f"""
SELECT census_block_group, AVG(c_custkey % 40 + 30) AS b01002e1
FROM {_CBG} GROUP BY census_block_group""", [_CBG])
FX["fx_b23"] = (f"""
SELECT census_block_group,
  CAST(SUM(c_custkey % 400 + 50) AS BIGINT) AS b23025e3,
  CAST(SUM(c_custkey % 23) AS BIGINT) AS b23025e5
FROM {_CBG} WHERE c_custkey % 19 != 4 GROUP BY census_block_group""", [_CBG])

FX["fx_votes"] = ("""
SELECT 'county_' || CAST(county_fips AS STRING) AS county_name, county_fips, votes_gop, votes_dem,
  votes_gop + votes_dem AS total_votes,
  votes_gop / (votes_gop + votes_dem) AS per_gop,
  votes_dem / (votes_gop + votes_dem) AS per_dem,
  votes_gop / (votes_gop + votes_dem) - votes_dem / (votes_gop + votes_dem) AS per_point_diff,
  votes_dem - votes_gop AS dem_margin,
  votes_gop - votes_dem AS rep_margin
FROM (
  SELECT CAST(c_nationkey AS BIGINT) * 1000 + c_custkey % 20 AS county_fips,
    CAST(SUM(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey % 500 + 100
                  ELSE c_custkey % 50 END) AS BIGINT) AS votes_gop,
    CAST(SUM(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey % 50
                  ELSE c_custkey % 500 + 100 END) AS BIGINT) AS votes_dem
  FROM customer GROUP BY 1) t""", [])

FX["fx_image_tags"] = ("""
SELECT l_orderkey AS property_id, l_linenumber AS image_idx, l_partkey AS image_part,
  l_suppkey AS image_supplier,
  CASE WHEN l_linenumber = 5 THEN p_name || 's' WHEN l_linenumber = 6 THEN REPLACE(p_name, ' ', '-') ELSE p_name END AS tag,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE ABS(ROUND(l_discount * 100, 1)) END AS granular_condition_num,
  ROUND(l_tax * 50 + 1, 1) AS high_condition_num,
  CASE WHEN l_linestatus = 'O' THEN 'Indoor' ELSE 'Exterior' END AS image_type
FROM lineitem JOIN part ON l_partkey = p_partkey""", [])

# Orders whose dict string parses (not truncated, not NULL).
FX["fx_parsed_ok"] = ("""
SELECT DISTINCT property_id FROM fx_image_tags
WHERE property_id % 50 NOT IN (7, 13)""", ["fx_image_tags"])

FX["fx_listings"] = (f"""
SELECT o_orderkey AS cc_list_id,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE ROUND(o_totalprice * 4.2, 2) END AS price,
  CAST(o_orderdate AS DATE) AS a_date,
  ({_list(STATE_CODES)})[o_custkey % 25 + 1] AS state,
  'city_' || CAST(o_custkey % 30 AS STRING) AS city,
  'sub_' || CAST(o_custkey % 150 AS STRING) AS subdivision,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL
       ELSE (['Single Family', 'Condo', 'Townhouse', 'Multi Family'])[o_custkey % 4 + 1] END AS property_sub_type,
  LPAD(CAST(o_custkey % 20 AS STRING), 3, '0') AS fips_county_cd,
  25.0 + CAST(o_custkey % 2000 AS DOUBLE) / 100 AS latitude,
  -70.0 - CAST(o_custkey % 5000 AS DOUBLE) / 100 AS longitude,
  1900 + o_orderkey % 130 AS year_built,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 1950 + o_orderkey % 70 END AS effective_year_built,
  o_orderkey % 4 + 1 AS bedrooms,
  o_orderkey % 3 + 1 AS full_baths,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 2 END AS half_baths,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 3000 + 600 AS DOUBLE) END AS gla_sqft,
  CAST((o_custkey % 50 + 1) * 1000 AS DOUBLE) AS lot_sqft,
  o_orderkey % 4 AS garage_spaces,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Private' END AS pool_spa_types,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 3 END AS fireplace_count,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 40 * 10 AS DOUBLE) END AS hoa_fee_amount,
  2023 + o_orderkey % 4 AS assessed_year,
  ROUND(o_totalprice * 3, 0) AS assessed_total_value,
  o_totalprice * 0.03 AS tax_amount,
  o_totalprice * 4 AS most_recent_sale,
  o_orderkey % 120 AS mls_days_on_market
FROM orders""", [])

FX["fx_address"] = ("""
SELECT o_orderkey // 4 AS address_id,
  list_sort(list(CAST(o_orderkey AS STRING))) AS mls_ids,
  list_sort(list(DISTINCT CAST(o_custkey AS STRING))) AS assessor_ids
FROM orders GROUP BY 1""", [])

# ---- derived views: census roll-up and the property extract -------------

FX["fx_census"] = ("""
SELECT LEFT(a.census_block_group, 11) AS census_tract,
  CAST(SUM(a.b15002e1) AS BIGINT) AS total_population_25plus,
  CAST(SUM(a.b15002e15) AS BIGINT) AS male_bachelors_degree,
  CAST(SUM(a.b15002e32) AS BIGINT) AS female_bachelors_degree,
  CASE WHEN SUM(a.b15002e1) > 0 THEN 100.0::DOUBLE * CAST(SUM(a.b15002e15) + SUM(a.b15002e32) AS DOUBLE)
       / CAST(SUM(a.b15002e1) AS DOUBLE) END AS pct_bachelors_degree,
  CAST(SUM(c.b03002e1) AS BIGINT) AS total_population,
  CAST(SUM(c.b03002e3) AS BIGINT) AS non_hispanic_white_population,
  CASE WHEN SUM(c.b03002e1) > 0 THEN 100.0::DOUBLE * CAST(SUM(c.b03002e3) AS DOUBLE)
       / CAST(SUM(c.b03002e1) AS DOUBLE) END AS pct_white,
  AVG(d.b20002e1) AS median_earnings_total,
  AVG(d.b20002e2) AS median_earnings_male,
  AVG(d.b20002e3) AS median_earnings_female,
  AVG(i.b19013e1) AS median_household_income,
  AVG(h.b25077e1) AS median_home_value,
  AVG(h.b25064e1) AS median_gross_rent,
  CAST(SUM(h.b25003e2) AS BIGINT) AS owner_occupied_units,
  CAST(SUM(h.b25003e3) AS BIGINT) AS renter_occupied_units,
  CAST(SUM(h.b25002e2) AS BIGINT) AS occupied_units,
  CAST(SUM(h.b25002e3) AS BIGINT) AS vacant_units,
  CASE WHEN SUM(h.b25003e1) > 0 THEN 100.0::DOUBLE * CAST(SUM(h.b25003e2) AS DOUBLE)
       / CAST(SUM(h.b25003e1) AS DOUBLE) END AS pct_owner_occupied,
  CASE WHEN SUM(h.b25002e2) + SUM(h.b25002e3) > 0 THEN 100.0::DOUBLE * CAST(SUM(h.b25002e3) AS DOUBLE)
       / CAST(SUM(h.b25002e2) + SUM(h.b25002e3) AS DOUBLE) END AS vacancy_rate,
  AVG(g.b01002e1) AS median_age,
  CAST(SUM(e.b23025e3) AS BIGINT) AS civilian_employed,
  CAST(SUM(e.b23025e5) AS BIGINT) AS civilian_unemployed,
  CASE WHEN SUM(e.b23025e3) + SUM(e.b23025e5) > 0 THEN 100.0::DOUBLE * CAST(SUM(e.b23025e5) AS DOUBLE)
       / CAST(SUM(e.b23025e3) + SUM(e.b23025e5) AS DOUBLE) END AS unemployment_rate,
  CAST(NULL AS DECIMAL(38,0)) AS population_below_poverty,
  CAST(NULL AS DOUBLE) AS poverty_rate
FROM fx_b15 a
LEFT JOIN fx_b03 c ON a.census_block_group = c.census_block_group
LEFT JOIN fx_b20 d ON a.census_block_group = d.census_block_group
LEFT JOIN fx_b19 i ON a.census_block_group = i.census_block_group
LEFT JOIN fx_b25 h ON a.census_block_group = h.census_block_group
LEFT JOIN fx_b01 g ON a.census_block_group = g.census_block_group
LEFT JOIN fx_b23 e ON a.census_block_group = e.census_block_group
GROUP BY 1""", ["fx_b15", "fx_b03", "fx_b20", "fx_b19", "fx_b25", "fx_b01", "fx_b23"])

_BASE_SELECT = """
  p.propertyid AS property_id, p.currentsalesprice AS sale_price, p.currentsalerecordingdate AS sale_date,
  p.situslatitude AS latitude, p.situslongitude AS longitude, p.situsstate AS state, p.situscity AS city,
  p.situszip5 AS zip, p.situscensustract AS census_tract, p.yearbuilt AS year_built,
  p.effectiveyearbuilt AS effective_year_built,
  COALESCE(p.effectiveyearbuilt, p.yearbuilt) AS year_built_final,
  p.sumlivingareasqft AS living_sqft, p.lotsizesqft AS lot_sqft, p.lotsizeacres AS lot_acres,
  p.bedrooms AS bedrooms, p.bathfull AS full_baths, p.bathspartialnbr AS half_baths,
  p.totalrooms AS total_rooms, p.garageparkingnbr AS garage_spaces, p.fireplacecode AS fireplace_code,
  CASE WHEN p.fireplacecode IS NOT NULL THEN 1 ELSE 0 END AS has_fireplace,
  p.buildingqualitycode AS building_quality, p.buildingconditioncode AS building_condition,
  p.stylecode AS architectural_style, p.poolcode AS pool_code,
  CASE WHEN p.poolcode IS NOT NULL AND p.poolcode > 0 THEN 1 ELSE 0 END AS has_pool,
  p.storiesnbrcode AS stories, p.airconditioningcode AS ac_code,
  CASE WHEN p.airconditioningcode IS NOT NULL AND p.airconditioningcode > 0 THEN 1 ELSE 0 END AS has_ac,
  p.basementcode AS basement_code, p.basementfinishedsqft AS basement_finished_sqft,
  CASE WHEN p.basementcode IS NOT NULL THEN 1 ELSE 0 END AS has_basement,
  p.watercode AS water_code,
  CASE WHEN p.watercode IS NOT NULL AND p.watercode > 0 THEN 1 ELSE 0 END AS has_water_feature,
  p.assdtotalvalue AS assessed_total_value, p.assdlandvalue AS assessed_land_value,
  p.assdimprovementvalue AS assessed_improvement_value, p.marketvalueland AS market_value_land,
  p.marketvalueimprovement AS market_value_improvements, p.topographycode AS topography_code,
  p.siteinfluencecode AS site_influence_code, p.exteriorwallscode AS exterior_walls_code,
  p.roofcovercode AS roof_cover_code, p.owneroccupied AS is_owner_occupied,
  p.prevsalesprice AS previous_sale_price, p.prevsalerecordingdate AS previous_sale_date,
  p.subdivisionname AS subdivision, p.zoning AS zoning,
  c.total_population_25plus, c.male_bachelors_degree, c.female_bachelors_degree, c.pct_bachelors_degree,
  c.total_population, c.non_hispanic_white_population, c.pct_white,
  c.median_earnings_total, c.median_earnings_male, c.median_earnings_female, c.median_household_income,
  c.median_home_value, c.median_gross_rent, c.owner_occupied_units, c.renter_occupied_units,
  c.pct_owner_occupied, c.occupied_units, c.vacant_units, c.vacancy_rate,
  c.median_age, c.civilian_employed, c.civilian_unemployed, c.unemployment_rate,
  c.median_household_income * c.total_population / 1000000.0 AS wealth_concentration_index,
  c.pct_bachelors_degree * c.median_household_income / 100000.0 AS education_income_index,
  v.county_name, v.county_fips, v.votes_gop, v.votes_dem, v.total_votes, v.per_gop, v.per_dem,
  v.per_point_diff, v.dem_margin, v.rep_margin,
  ABS(v.per_gop - v.per_dem) AS political_lean_strength,
  LEFT(LPAD(TRIM(CAST(p.fips AS STRING)), 5, '0'), 2) AS state_fips"""

_BASE_FROM = """
FROM fx_assessor p
LEFT JOIN fx_census c
  ON LEFT(LPAD(TRIM(CAST(p.fips AS STRING)), 5, '0'), 5) || TRIM(p.situscensustract) = c.census_tract
LEFT JOIN fx_votes v
  ON LEFT(LPAD(TRIM(CAST(p.fips AS STRING)), 5, '0'), 5) = LPAD(TRIM(CAST(v.county_fips AS STRING)), 5, '0')"""

_QUALITY = """
  p.currentsalesprice IS NOT NULL AND p.sumlivingareasqft IS NOT NULL AND p.lotsizesqft IS NOT NULL
  AND p.situslatitude IS NOT NULL AND p.situslongitude IS NOT NULL
  AND p.currentsalesprice BETWEEN 10000 AND 100000000
  AND p.sumlivingareasqft > 0 AND p.lotsizesqft > 0 AND p.bedrooms > 0"""

FX["fx_base"] = (f"SELECT {_BASE_SELECT} {_BASE_FROM}\nWHERE p.situsstate IN {_in(TOP10_STATES)} AND {_QUALITY}",
                 ["fx_assessor", "fx_census", "fx_votes"])
# The extract used by the modelling side: every state.
FX["fx_extract"] = (f"SELECT {_BASE_SELECT} {_BASE_FROM}\nWHERE {_QUALITY}",
                    ["fx_assessor", "fx_census", "fx_votes"])


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str):
        if n in seen:
            return
        for d in FX[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_fx(body: str, fixtures: list[str], extra: list[tuple[str, str]] = ()) -> str:
    """``WITH <fixtures in dependency order>, <extra CTEs> <body>``."""
    parts = [f"{n} AS ({FX[n][0]}\n)" for n in _order(fixtures)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in extra]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body

# Double-typed output columns of the derived views (rounded in oracles).
CENSUS_DOUBLES = ["pct_bachelors_degree", "pct_white", "median_earnings_total", "median_earnings_male",
                  "median_earnings_female", "median_household_income", "median_home_value",
                  "median_gross_rent", "pct_owner_occupied", "vacancy_rate", "median_age",
                  "unemployment_rate", "poverty_rate"]
BASE_DOUBLES = ["sale_price", "latitude", "longitude", "living_sqft", "lot_acres",
                "assessed_total_value", "assessed_land_value", "assessed_improvement_value",
                "market_value_land", "market_value_improvements", "previous_sale_price"] + \
               [c for c in CENSUS_DOUBLES if c != "poverty_rate"] + \
               ["wealth_concentration_index", "education_income_index", "per_gop", "per_dem",
                "per_point_diff", "political_lean_strength"]

FX["fx_tagged"] = ("""
SELECT property_id,
  CASE WHEN property_id % 50 IN (7, 13) THEN []::VARCHAR[] ELSE list_sort(list(DISTINCT tag)) END AS tags
FROM fx_image_tags GROUP BY property_id""", ["fx_image_tags"])
FX["fx_tag_long"] = ("""
SELECT DISTINCT t.property_id, u.tag FROM fx_tagged t, UNNEST(t.tags) AS u(tag)""", ["fx_tagged"])
FX["fx_tag_counts"] = ("""
SELECT tag, COUNT(*) AS n_docs FROM fx_tag_long GROUP BY tag""", ["fx_tag_long"])

ASSESSOR_DOUBLES = ["currentsalesprice", "situslatitude", "situslongitude", "sumlivingareasqft",
                    "lotsizeacres", "sumbuildingsqft", "sumgrossareasqft", "assdtotalvalue", "assdlandvalue", "assdimprovementvalue",
                    "marketvalueland", "marketvalueimprovement", "prevsalesprice"]
PAD5 = "LEFT(LPAD(TRIM(CAST({} AS STRING)), 5, '0'), 5)"

# ---- prediction, importance and topic tables (deterministic stand-ins) ----

def tier_case(col: str, table) -> str:
    parts = []
    for name, lo, hi in table:
        parts.append(f"WHEN {col} >= {lo} THEN '{name}'" if hi == float("inf")
                     else f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{name}'")
    return "CASE " + " ".join(parts) + " ELSE 'ultra_high' END"


def _pred(prime: int) -> str:
    return f"sale_price * (1 + CAST((property_id * {prime}) % 41 - 20 AS DOUBLE) / 100)"


from propval.functions.tiers import PRICE_TIERS as _PT, PRICE_TIERS_POOLED as _PTP  # noqa: E402

FX["fx_predictions"] = (f"""
SELECT property_id, state, sale_price AS actual, {_pred(7919)} AS predicted,
  {_pred(7919)} * 0.85 AS pred_lower, {_pred(7919)} * 1.15 AS pred_upper,
  {tier_case('sale_price', _PT)} AS price_tier,
  living_sqft, bedrooms, LEAST(GREATEST(2026 - year_built, 0), 200) AS property_age, lot_sqft,
  full_baths + 0.5::DOUBLE * COALESCE(half_baths, 0) AS total_baths
FROM fx_extract""", ["fx_extract"])

METHODS = [("BASELINE", 7919), ("LDA", 7927), ("NMF", 7933), ("BERTOPIC", 7937)]
FX["fx_method_predictions"] = ("\nUNION ALL\n".join(f"""
SELECT property_id, '{m}' AS method, sale_price AS actual, {_pred(p)} AS predicted,
  {tier_case('sale_price', _PTP)} AS price_tier FROM fx_extract""" for m, p in METHODS), ["fx_extract"])

IMPORTANCE_FEATURES = ["living_sqft", "lot_sqft", "year_built", "bedrooms", "full_baths", "garage_spaces",
                       "latitude", "longitude", "median_household_income", "median_home_value",
                       "pct_bachelors_degree", "per_gop", "total_population", "vacancy_rate"]
FX["fx_importance"] = ("\nUNION ALL\n".join(f"""
SELECT CASE WHEN sale_price < 200000 THEN 0 WHEN sale_price < 1000000 THEN 1 ELSE 2 END AS tier,
  '{f}' AS feature,
  floor(COALESCE(CASE WHEN isnan(abs(corr(CAST({f} AS DOUBLE), sale_price))) THEN 0.0
                      ELSE abs(corr(CAST({f} AS DOUBLE), sale_price)) END, 0.0) * 1000000.0 + 0.5) / 1000000.0
    AS importance,
  COUNT(*) FILTER (WHERE NOT (substr(md5(CAST(property_id AS STRING) || '|42'), 1, 4) < 'cccd')) AS n_test
FROM fx_extract GROUP BY 1""" for f in IMPORTANCE_FEATURES), ["fx_extract"])

N_TOPICS = 8
_RAW = [f"((property_id * {7 + 31 * j}) % 97 + 1)" for j in range(1, N_TOPICS + 1)]
FX["fx_topics"] = (f"""
SELECT property_id, sale_price, {tier_case('sale_price', _PT)} AS price_tier,
  {', '.join(f'CAST({r} AS DOUBLE) / ({" + ".join(_RAW)}) AS topic_{j}' for j, r in enumerate(_RAW, 1))}
FROM fx_extract""", ["fx_extract"])
FX["fx_topic_terms"] = (f"""
SELECT t.topic, c.tag AS term,
  CAST(c.n_docs * ((t.topic * 13 + c.rk * 7) % 23 + 1) AS DOUBLE) AS weight
FROM (SELECT tag, n_docs, ROW_NUMBER() OVER (ORDER BY n_docs DESC, tag) AS rk FROM fx_tag_counts) c,
     range(1, {N_TOPICS + 1}) AS t(topic)""", ["fx_tag_counts"])
