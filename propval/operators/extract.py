"""SQL-extract family: census roll-up, property base, joins, filters, samples.

Each function is ``DataFrame(s) -> DataFrame`` and stays declarative so that
Catalyst pushes filters into the scans, prunes columns and lets AQE pick the
join strategy from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.functions.keys import block_group_tract, county_fips, state_fips, tract_key
from propval.functions.mathx import guarded_pct
from propval.sources.io import stored

# The ten states of the stratified extract.
TOP10_STATES = ["ca", "tx", "ny", "fl", "il", "pa", "oh", "ga", "wa", "nj"]

# Assessor column -> extract column (aliased projection).
ASSESSOR_RENAMES = [
    ("propertyid", "property_id"), ("currentsalesprice", "sale_price"),
    ("currentsalerecordingdate", "sale_date"), ("situslatitude", "latitude"),
    ("situslongitude", "longitude"), ("situsstate", "state"), ("situscity", "city"),
    ("situszip5", "zip"), ("situscensustract", "census_tract"), ("yearbuilt", "year_built"),
    ("effectiveyearbuilt", "effective_year_built"), ("sumlivingareasqft", "living_sqft"),
    ("lotsizesqft", "lot_sqft"), ("lotsizeacres", "lot_acres"), ("bedrooms", "bedrooms"),
    ("bathfull", "full_baths"), ("bathspartialnbr", "half_baths"), ("totalrooms", "total_rooms"),
    ("garageparkingnbr", "garage_spaces"), ("fireplacecode", "fireplace_code"),
    ("buildingqualitycode", "building_quality"), ("buildingconditioncode", "building_condition"),
    ("stylecode", "architectural_style"), ("poolcode", "pool_code"), ("storiesnbrcode", "stories"),
    ("airconditioningcode", "ac_code"), ("basementcode", "basement_code"),
    ("basementfinishedsqft", "basement_finished_sqft"), ("watercode", "water_code"),
    ("assdtotalvalue", "assessed_total_value"), ("assdlandvalue", "assessed_land_value"),
    ("assdimprovementvalue", "assessed_improvement_value"), ("marketvalueland", "market_value_land"),
    ("marketvalueimprovement", "market_value_improvements"), ("topographycode", "topography_code"),
    ("siteinfluencecode", "site_influence_code"), ("exteriorwallscode", "exterior_walls_code"),
    ("roofcovercode", "roof_cover_code"), ("owneroccupied", "is_owner_occupied"),
    ("prevsalesprice", "previous_sale_price"), ("prevsalerecordingdate", "previous_sale_date"),
    ("subdivisionname", "subdivision"), ("zoning", "zoning"),
]

CENSUS_COLUMNS = [
    "total_population_25plus", "male_bachelors_degree", "female_bachelors_degree",
    "pct_bachelors_degree", "total_population", "non_hispanic_white_population", "pct_white",
    "median_earnings_total", "median_earnings_male", "median_earnings_female",
    "median_household_income", "median_home_value", "median_gross_rent",
    "owner_occupied_units", "renter_occupied_units", "pct_owner_occupied", "occupied_units",
    "vacant_units", "vacancy_rate", "median_age", "civilian_employed", "civilian_unemployed",
    "unemployment_rate",
]
VOTE_COLUMNS = ["county_name", "county_fips", "votes_gop", "votes_dem", "total_votes",
                "per_gop", "per_dem", "per_point_diff", "dem_margin", "rep_margin"]


# --------------------------------------------------------------------------
# Census roll-up
# --------------------------------------------------------------------------

def _joined_block_groups(cbg: dict[str, DataFrame], state_prefixes=None) -> DataFrame:
    """B15 left-joined to the sibling tables on the block-group key.

    B17 (poverty) is joined in the reference but no column of it is used;
    the key is unique, so the join cannot change any aggregate and is left
    out.
    """
    key = "census_block_group"
    base = cbg["b15"]
    if state_prefixes:
        pred = None
        for p in state_prefixes:
            c = F.col(key).startswith(p)
            pred = c if pred is None else pred | c
        base = base.filter(pred)
    out = base
    for name in ("b03", "b20", "b19", "b25", "b01", "b23"):
        out = out.join(cbg[name], key, "left")
    return out


def census_tract_rollup(cbg: dict[str, DataFrame], state_prefixes=None,
                        sum_of_sums: bool = True) -> DataFrame:
    """Block groups rolled up to 11-character tracts.

    Counts are summed, medians averaged, percentages are guarded ratios of
    sums (NULL when the denominator is not positive).  ``sum_of_sums``
    chooses ``SUM(a)+SUM(b)`` (True) or ``SUM(a+b)`` (False) for the degree
    numerator; they differ when one side is NULL.
    """
    j = _joined_block_groups(cbg, state_prefixes)
    s = lambda c: F.sum(c)
    degree_num = (s("b15002e15") + s("b15002e32")) if sum_of_sums else s(F.col("b15002e15") + F.col("b15002e32"))
    occ = s("b25002e2") + s("b25002e3")
    lab = s("b23025e3") + s("b23025e5")
    return (j.groupBy(block_group_tract(F.col("census_block_group")).alias("census_tract"))
             .agg(s("b15002e1").alias("total_population_25plus"),
                  s("b15002e15").alias("male_bachelors_degree"),
                  s("b15002e32").alias("female_bachelors_degree"),
                  guarded_pct(degree_num, s("b15002e1")).alias("pct_bachelors_degree"),
                  s("b03002e1").alias("total_population"),
                  s("b03002e3").alias("non_hispanic_white_population"),
                  guarded_pct(s("b03002e3"), s("b03002e1")).alias("pct_white"),
                  F.avg("b20002e1").alias("median_earnings_total"),
                  F.avg("b20002e2").alias("median_earnings_male"),
                  F.avg("b20002e3").alias("median_earnings_female"),
                  F.avg("b19013e1").alias("median_household_income"),
                  F.avg("b25077e1").alias("median_home_value"),
                  F.avg("b25064e1").alias("median_gross_rent"),
                  s("b25003e2").alias("owner_occupied_units"),
                  s("b25003e3").alias("renter_occupied_units"),
                  s("b25002e2").alias("occupied_units"),
                  s("b25002e3").alias("vacant_units"),
                  guarded_pct(s("b25003e2"), s("b25003e1")).alias("pct_owner_occupied"),
                  guarded_pct(s("b25002e3"), occ).alias("vacancy_rate"),
                  F.avg("b01002e1").alias("median_age"),
                  s("b23025e3").alias("civilian_employed"),
                  s("b23025e5").alias("civilian_unemployed"),
                  guarded_pct(s("b23025e5"), lab).alias("unemployment_rate"),
                  *typed_null_columns()))


def typed_null_columns() -> list[Column]:
    """Placeholder poverty columns: ``CAST(NULL AS NUMBER)``, ``CAST(NULL AS FLOAT)``."""
    return [F.lit(None).cast("decimal(38,0)").alias("population_below_poverty"),
            F.lit(None).cast("double").alias("poverty_rate")]


# --------------------------------------------------------------------------
# Property base (aliased projection, amenity flags, joins, filters)
# --------------------------------------------------------------------------

def amenity_flags(p: str = "") -> list[Column]:
    """Presence flags and the effective year over raw assessor columns."""
    c = lambda n: F.col(p + n)
    present = lambda n: F.when(c(n).isNotNull(), 1).otherwise(0)
    positive = lambda n: F.when(c(n).isNotNull() & (c(n) > 0), 1).otherwise(0)
    return [
        F.coalesce(c("effectiveyearbuilt"), c("yearbuilt")).alias("year_built_final"),
        present("fireplacecode").alias("has_fireplace"),
        positive("poolcode").alias("has_pool"),
        positive("airconditioningcode").alias("has_ac"),
        present("basementcode").alias("has_basement"),
        positive("watercode").alias("has_water_feature"),
    ]


def quality_filter(df: DataFrame, price="currentsalesprice", living="sumlivingareasqft",
                   lot="lotsizesqft", lat="situslatitude", lon="situslongitude",
                   bedrooms="bedrooms", ranges: bool = True) -> DataFrame:
    """Not-null filter, and optionally the range / positivity filter."""
    cond = (F.col(price).isNotNull() & F.col(living).isNotNull() & F.col(lot).isNotNull()
            & F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if ranges:
        cond = (cond & F.col(price).between(10000, 100000000) & (F.col(living) > 0)
                & (F.col(lot) > 0) & (F.col(bedrooms) > 0))
    return df.filter(cond)


def property_rows(assessor: DataFrame, states: list[str] | None = TOP10_STATES, ranges: bool = True) -> DataFrame:
    """The assessor rows of the extract: its states and quality filters."""
    rows = assessor if states is None else assessor.filter(F.col("situsstate").isin(states))
    return quality_filter(rows, ranges=ranges)


def property_base(assessor: DataFrame, census: DataFrame, votes: DataFrame,
                  states: list[str] | None = TOP10_STATES, ranges: bool = True) -> DataFrame:
    """The extract: assessor + tract census + county votes, filtered.

    The tract join key is padded county FIPS + 6-digit tract; the county key
    is padded on both sides (numeric FIPS lose leading zeros).
    """
    p = property_rows(assessor, states, ranges)
    p = p.withColumn("_tract", tract_key(F.col("fips"), F.col("situscensustract"))) \
         .withColumn("_county", county_fips(F.col("fips")))
    c = census.withColumnRenamed("census_tract", "_tract")
    v = votes.withColumn("_county", county_fips(F.col("county_fips")))
    j = p.join(c, "_tract", "left").join(v, "_county", "left")
    # flag columns follow the raw column they are derived from
    after = dict(zip(["effectiveyearbuilt", "fireplacecode", "poolcode", "airconditioningcode",
                      "basementfinishedsqft", "watercode"], amenity_flags()))
    sel = []
    for src, dst in ASSESSOR_RENAMES:
        sel.append(F.col(src).alias(dst))
        if src in after:
            sel.append(after[src])
    sel += [F.col(c) for c in CENSUS_COLUMNS]
    sel += [area_index_columns()[0], area_index_columns()[1]]
    sel += [F.col(c) for c in VOTE_COLUMNS]
    sel += [F.abs(F.col("per_gop") - F.col("per_dem")).alias("political_lean_strength"),
            state_fips(F.col("fips")).alias("state_fips")]
    return j.select(*sel)


def area_index_columns() -> list[Column]:
    """Wealth concentration and education-income indices."""
    return [
        (F.col("median_household_income") * F.col("total_population") / 1000000.0)
        .alias("wealth_concentration_index"),
        (F.col("pct_bachelors_degree") * F.col("median_household_income") / 100000.0)
        .alias("education_income_index"),
    ]


def star_join(assessor: DataFrame, census: DataFrame, votes: DataFrame) -> DataFrame:
    """``p.*, c.*, v.*`` plus normalised FIPS; colliding names get a prefix.

    ``county_fips`` exists in the vote table and is also derived from the
    assessor, so the vote copy becomes ``v_county_fips``.
    """
    p = assessor.withColumn("state_fips", state_fips(F.col("fips"))) \
                .withColumn("county_fips", county_fips(F.col("fips")))
    taken = set(p.columns)
    cren = {n: f"c_{n}" for n in census.columns if n in taken}
    c = census.withColumnsRenamed(cren)
    taken |= set(c.columns)
    vren = {n: f"v_{n}" for n in votes.columns if n in taken}
    v = votes.withColumnsRenamed(vren)
    ckey = F.col(cren.get("census_tract", "census_tract"))
    vkey = county_fips(F.col(vren.get("county_fips", "county_fips")))
    return (p.join(c, tract_key(p.fips, p.situscensustract) == ckey, "left")
             .join(v, p.county_fips == vkey, "left"))


# --------------------------------------------------------------------------
# Filters
# --------------------------------------------------------------------------

def region_filter(df: DataFrame, spec, state_col: str = "situsstate",
                  fips_col: str = "fips") -> DataFrame:
    """OR over ``(state, include_counties, exclude_counties)`` clauses.

    ``include`` / ``exclude`` are lists of 5-character county codes or None.
    """
    county = county_fips(F.col(fips_col))
    pred = None
    for state, include, exclude in spec:
        c = F.col(state_col) == state
        if include:
            c = c & county.isin(include)
        if exclude:
            c = c & ~county.isin(exclude)
        pred = c if pred is None else pred | c
    return df.filter(pred)


def state_fips_filter(df: DataFrame, state_codes: list[str], exclude_counties=(),
                      exclude_state: str | None = None, fips_col: str = "fips") -> DataFrame:
    """Filter on columns computed in the same projection (lateral alias)."""
    d = df.withColumn("state_fips", state_fips(F.col(fips_col))) \
          .withColumn("county_fips", county_fips(F.col(fips_col)))
    cond = F.col("state_fips").isin(state_codes)
    if exclude_counties:
        hit = F.col("county_fips").isin(list(exclude_counties))
        if exclude_state is not None:
            hit = (F.col("state_fips") == exclude_state) & hit
        cond = cond & ~hit
    return d.filter(cond)


def price_bounds(df: DataFrame, price: str, low=None, high=None) -> DataFrame:
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(price) >= low)
    if high is not None:
        cond = cond & (F.col(price) <= high)
    return df.filter(cond)


# --------------------------------------------------------------------------
# Samples and set operations
# --------------------------------------------------------------------------

SALTS = 32               # parts of a group in the first round of a sample
MOST_CUTS = 10_000       # groups whose cuts are sent to every task (under 1 MB)


def hash_order(id_col: Column, seed: int = 42) -> Column:
    """Repeatable pseudo-random order key: ``md5(id || '|' || seed)``."""
    return F.md5(F.concat(id_col.cast("string"), F.lit(f"|{seed}")))


def sample_per_group(df: DataFrame, group_col: str, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY g ORDER BY random) <= n``.

    The order is a hash of the id, so the sample is repeatable and does not
    depend on partitioning.  ``row_number() <= n`` lets Spark insert a
    partial ``WindowGroupLimit`` before the shuffle, so a map task sends at
    most ``n`` rows of a group; the first round does that within ``SALTS``
    parts of each group, so the task that ends a hot group gets at most
    ``SALTS * n`` rows, however many tasks feed it.
    """
    order = [hash_order(F.col(id_col), seed), F.col(id_col)]
    salted = Window.partitionBy(group_col, "_salt").orderBy(*order)
    first = (df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
               .withColumn("_rn", F.row_number().over(salted)).filter(F.col("_rn") <= n))
    whole = Window.partitionBy(group_col).orderBy(*order)
    return first.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= n).drop("_rn", "_salt")


def sample_cuts(df: DataFrame, group_col: str, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Per group the place in :func:`hash_order` of its n-th row (of its last,
    if it has fewer): the group's sample is the rows up to ``_cut``."""
    place = F.struct(hash_order(F.col(id_col), seed).alias("h"), F.col(id_col).alias("id"))
    return sample_per_group(df.select(group_col, id_col), group_col, n, id_col, seed).groupBy(group_col).agg(F.max(place).alias("_cut"))


def sample_or_above(df: DataFrame, cuts: DataFrame, group_col: str, id_col: str, price_col: str, threshold: float, seed: int = 42) -> DataFrame:
    """Rows of df up to their group's ``_cut`` or above the price, in one pass.
    The cuts are a row a group: they are sent to every task where they are at
    most ``MOST_CUTS`` rows and joined by Spark's own choice beyond."""
    place = F.struct(hash_order(F.col(id_col), seed).alias("h"), F.col(id_col).alias("id"))
    cuts = cuts.withColumnRenamed(group_col, "_group")
    side = F.broadcast(cuts) if cuts.count() <= MOST_CUTS else cuts
    return (df.join(side, F.col(group_col).eqNullSafe(F.col("_group")), "left")
            .filter((F.col(price_col) > threshold) | (place <= F.col("_cut"))).drop("_group", "_cut"))


def stratified_extract(assessor: DataFrame, census: DataFrame, votes: DataFrame, states: list[str] | None = TOP10_STATES,
                       n_per_state: int = 1000, threshold: float = 800000, seed: int = 42) -> DataFrame:
    """Random sample per state UNION all rows above ``threshold``, price desc.

    Rows are unique by property, so the distinct union is one filter: up to
    the state's cut, or above the threshold.  The cuts come from the state and
    id of the assessor rows alone, and only chosen rows meet the census and
    the votes, each of which is read once.
    """
    rows = property_rows(assessor, states).withColumn("_state", state_fips(F.col("fips")))
    cuts = stored(sample_cuts(rows, "_state", n_per_state, "propertyid", seed), "cuts")
    chosen = sample_or_above(rows, cuts, "_state", "propertyid", "currentsalesprice", threshold, seed)
    return property_base(chosen, census, votes, states=None).orderBy(F.col("sale_price").desc(), F.col("property_id"))


def id_bridge(address: DataFrame) -> DataFrame:
    """Every distinct (mls_id, assessor_id) of one address, by assessor id."""
    return (address.select(F.explode("mls_ids").alias("mls_id"), "assessor_ids")
                   .select("mls_id", F.explode("assessor_ids").alias("assessor_id"))
                   .distinct()
                   .orderBy("assessor_id", "mls_id"))


def listings_by_property(bridge: DataFrame, listings: DataFrame, price: str = "price", date: str = "a_date") -> DataFrame:
    """Listings over the bridge, by assessor id: number of listings, of those
    with a price, their extremes and the last date.  ``bridge`` is bucketed by
    the listing id, so it is joined where it lies."""
    j = bridge.join(listings.withColumn("mls_id", F.col("cc_list_id").cast("string")), "mls_id")
    return j.groupBy("assessor_id").agg(F.count(F.lit(1)).alias("n_listings"), F.count(price).alias("n_priced"), F.min(price).alias("min_price"),
                                        F.max(price).alias("max_price"), F.max(date).alias("last_date"))


def county_join(df: DataFrame, votes: DataFrame, fips_col: str = "fips", pad: bool = True) -> DataFrame:
    """Left join to county votes; ``pad=False`` reproduces the lossy key."""
    if pad:
        left_key, right_key = county_fips(F.col(fips_col)), county_fips(F.col("v.county_fips"))
    else:
        left_key = F.substring(F.col(fips_col).cast("string"), 1, 5)
        right_key = F.col("v.county_fips").cast("string")
    v = votes.alias("v")
    return df.join(v, left_key == right_key, "left")


def tract_concat_join(df: DataFrame, census: DataFrame, pad: bool = False) -> DataFrame:
    """Left join on ``LEFT(FIPS, 5) || tract = census_tract``."""
    fips5 = county_fips(F.col("fips")) if pad else F.substring(F.col("fips").cast("string"), 1, 5)
    c = census.alias("c")
    return df.join(c, F.concat(fips5, F.col("situscensustract")) == F.col("c.census_tract"), "left")
