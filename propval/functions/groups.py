"""Feature groups and toggles of the pooled workflow (plan-time constants)."""

from __future__ import annotations

# Feature groups as published, keyed by toggle.
FEATURE_GROUPS = {
    "mls": {
        "base_property": ["living_sqft", "lot_sqft", "year_built", "effective_year_built", "bedrooms",
                          "full_baths", "half_baths", "garage_spaces", "fireplace_code", "latitude",
                          "longitude", "geo_cluster"],
        "engineered": ["sqft_per_bedroom", "lot_to_living_ratio", "property_age", "is_new", "has_garage",
                       "luxury_score", "log_sqft", "age_squared"],
        "prior_sale": ["prior_sale_price", "prior_price_per_sqft", "sqft_per_prior_dollar",
                       "years_since_last_sale", "expected_appreciation", "has_prior_sale", "recently_sold"],
        "cluster": ["cluster_avg_price", "cluster_med_price"],
    },
    "census": {
        "education": ["total_population_25plus", "male_bachelors_degree", "female_bachelors_degree",
                      "pct_bachelors_degree"],
        "population": ["total_population", "non_hispanic_white_population", "pct_white"],
        "income": ["median_earnings_total", "median_earnings_male", "median_earnings_female",
                   "median_household_income"],
        "housing": ["median_home_value", "median_gross_rent", "owner_occupied_units", "renter_occupied_units",
                    "pct_owner_occupied", "occupied_units", "vacant_units"],
        "demographic": ["median_age", "civilian_employed", "civilian_unemployed", "unemployment_rate"],
        "census_engineered": ["income_education_score"],
    },
    "neighborhood": {
        "election": ["votes_gop", "votes_dem", "total_votes", "per_gop", "per_dem", "per_point_diff",
                     "dem_margin", "rep_margin"],
    },
    "image": {
        "topics": [f"topic_{i}" for i in range(1, 11)],
        "conditions": ["gran_c_in", "gran_c_ex", "gran_c", "high_c_in", "high_c_ex", "high_c"],
    },
}

DEFAULT_TOGGLES = {"mls": True, "census": True, "neighborhood": True, "image": False}


def active_groups(toggles: dict[str, bool] = DEFAULT_TOGGLES) -> list[tuple[str, str, str]]:
    """``(toggle, group, feature)`` for every feature of the enabled toggles."""
    out = []
    for toggle, groups in FEATURE_GROUPS.items():
        if toggles.get(toggle, False):
            for g, feats in groups.items():
                out += [(toggle, g, f) for f in feats]
    return out
