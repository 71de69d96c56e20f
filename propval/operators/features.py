"""Feature engineering, imputation, encoding, splits and outlier filters.

Column existence is known at plan time (``df.columns``), so every "if the
column exists" guard of the reference is a Python branch, never an action.
Statistics that feed back into a plan (medians, percentile thresholds,
label sets) are one-row or per-group aggregates of bounded size.
"""

from __future__ import annotations

from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propval.functions.mathx import ratio_plus_one
from propval.functions.quantiles import agg_with_quantiles, quantile_row, quantiles, stored_medians
from propval.sources.io import stored

# Physical -> logical column names of the assessor extract.
COLUMN_MAP = {
    "sumlivingareasqft": "living_sqft",
    "lotsizesqft": "lot_sqft",
    "sumbuildingsqft": "building_sqft",
    "sumbasementsqft": "basement_sqft",
    "basementfinishedsqft": "basement_finished_sqft",
    "sumgaragesqft": "garage_sqft",
    "sumgrossareasqft": "gross_sqft",
}


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def flag(cond: Column) -> Column:
    """Boolean to int8 with pandas semantics (NULL comparison is False)."""
    return F.coalesce(cond, F.lit(False)).cast("tinyint")


def clip(c: Column, lo: float, hi: float) -> Column:
    """``clip(lo, hi)`` that keeps NULL (``greatest``/``least`` skip NULLs)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def rename_columns(df: DataFrame, mapping: dict[str, str] = COLUMN_MAP) -> DataFrame:
    """Rename present columns (lower-cased first, like the CSV loaders)."""
    d = df.toDF(*[c.lower() for c in df.columns])
    return d.withColumnsRenamed({k: v for k, v in mapping.items() if k in d.columns})


def resolve_column(df: DataFrame, candidates: list[str], required: bool = True) -> str | None:
    """First candidate present in the frame (plan-time lookup)."""
    for c in candidates:
        if c in df.columns:
            return c
    if required:
        raise ValueError(f"none of {candidates} found")
    return None


def drop_leaky(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Drop columns if present (``drop`` is tolerant) and rows without target."""
    return df.drop(*columns).dropna(subset=[target])


def features_core(df: DataFrame, living="living_sqft", lot="lot_sqft", year="year_built",
                  bed="bedrooms", garage="garage_spaces", base_year: int = 2024) -> DataFrame:
    """sqft/bedroom, lot/living, age, has_garage, log sqft (when inputs exist)."""
    new = {}
    if _has(df, living, bed):
        new["sqft_per_bedroom"] = ratio_plus_one(F.col(living), F.col(bed))
    if _has(df, lot, living):
        new["lot_to_living_ratio"] = ratio_plus_one(F.col(lot), F.col(living))
    if _has(df, year):
        new["property_age"] = F.lit(base_year) - F.col(year)
    if _has(df, garage):
        new["has_garage"] = flag(F.col(garage) > 0)
    if _has(df, living):
        new["log_sqft"] = F.log1p(F.col(living).cast("double"))
    return df.withColumns(new)


def features_pooled(df: DataFrame, base_year: int = 2024, census: bool = True) -> DataFrame:
    """Core features + is_new, age squared, luxury score, income x education."""
    d = features_core(df, base_year=base_year)
    new = {}
    if "property_age" in d.columns:
        new["is_new"] = flag(F.col("property_age") <= 5)
        new["age_squared"] = F.pow(F.col("property_age").cast("double"), 2)
    terms = []
    if _has(d, "living_sqft"):
        terms.append(F.col("living_sqft") / 1000)
    if _has(d, "full_baths"):
        terms.append(F.col("full_baths").cast("double"))
    if _has(d, "garage_spaces"):
        terms.append(F.col("garage_spaces").cast("double"))
    if terms:
        new["luxury_score"] = reduce(lambda a, b: a + b, terms) / len(terms)
    if census and _has(d, "median_household_income", "pct_bachelors_degree"):
        new["income_education_score"] = F.col("median_household_income") * F.col("pct_bachelors_degree")
    return d.withColumns(new)


def features_prior_sale(df: DataFrame, as_of: str = "2024-01-01", census: bool = True,
                        appreciation: float = 0.04) -> DataFrame:
    """Prior-sale features; flags are computed before the fills.

    Missing prior price is filled with the area median home value when census
    data is on (else the overall median), missing years with 999.
    """
    d = df
    new = {}
    price, date = "prior_sale_price", "prior_sale_date"
    if _has(d, price, "living_sqft"):
        new["prior_price_per_sqft"] = ratio_plus_one(F.col(price), F.col("living_sqft"))
        new["sqft_per_prior_dollar"] = ratio_plus_one(F.col("living_sqft"), F.col(price))
    years = None
    if _has(d, date):
        years = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col(date))) / 365.25
        new["years_since_last_sale"] = years
    if _has(d, price) and years is not None:
        new["expected_appreciation"] = F.col(price) * F.pow(F.lit(1 + appreciation), years)
    if _has(d, price):
        new["has_prior_sale"] = F.col(price).isNotNull().cast("tinyint")
    if years is not None:
        new["recently_sold"] = flag(years < 2)
    d = d.withColumns(new)
    fills = {}
    if _has(d, price):
        if census and _has(d, "median_home_value"):
            fills[price] = F.coalesce(F.col(price), F.col("median_home_value"))
        else:
            med = quantile_row(d, {"m": (price, 0.5)})["m"]
            fills[price] = F.coalesce(F.col(price), F.lit(med))
    if "years_since_last_sale" in d.columns:
        fills["years_since_last_sale"] = F.coalesce(F.col("years_since_last_sale"), F.lit(999.0))
    return d.withColumns(fills)


def features_building(df: DataFrame) -> DataFrame:
    """Finished-basement ratio, large garage (> 500 sqft), living / gross."""
    new = {}
    if _has(df, "basement_finished_sqft", "basement_sqft"):
        new["basement_finished_ratio"] = ratio_plus_one(F.col("basement_finished_sqft"), F.col("basement_sqft"))
    if _has(df, "garage_sqft"):
        new["has_large_garage"] = flag(F.col("garage_sqft") > 500)
    if _has(df, "living_sqft", "gross_sqft"):
        new["living_to_gross_ratio"] = ratio_plus_one(F.col("living_sqft"), F.col("gross_sqft"))
    return df.withColumns(new)


def features_listing(df: DataFrame, base_year: int = 2026) -> DataFrame:
    """Listing features: clipped ages, total baths, size ratios, amenity flags, HOA."""
    new = {}
    if _has(df, "year_built"):
        new["property_age"] = clip(F.lit(base_year) - F.col("year_built"), 0, 200)
    if _has(df, "effective_year_built"):
        new["effective_age"] = clip(F.lit(base_year) - F.col("effective_year_built"), 0, 200)
    if _has(df, "full_baths", "half_baths"):
        new["total_baths"] = F.col("full_baths") + 0.5 * F.coalesce(F.col("half_baths"), F.lit(0))
    if _has(df, "gla_sqft", "lot_sqft"):
        new["gla_to_lot_ratio"] = ratio_plus_one(F.col("gla_sqft"), F.col("lot_sqft"))
    if _has(df, "gla_sqft", "bedrooms"):
        new["sqft_per_bedroom"] = ratio_plus_one(F.col("gla_sqft"), F.col("bedrooms"))
    if _has(df, "garage_spaces"):
        new["has_garage"] = flag(F.col("garage_spaces") > 0)
    if _has(df, "pool_spa_types"):
        new["has_pool"] = F.col("pool_spa_types").isNotNull().cast("int")
    if _has(df, "fireplace_count"):
        new["has_fireplace"] = flag(F.col("fireplace_count") > 0)
    if _has(df, "hoa_fee_amount"):
        new["hoa_monthly"] = F.coalesce(F.col("hoa_fee_amount"), F.lit(0.0))
    return df.withColumns(new)


def target_ratios(df: DataFrame, price: str, living: str = "living_sqft") -> DataFrame:
    """Price-based ratios used only for outlier filtering (dropped after)."""
    return df.withColumns({"price_per_sqft": ratio_plus_one(F.col(price), F.col(living)),
                           "sqft_per_dollar": ratio_plus_one(F.col(living), F.col(price))})


# --------------------------------------------------------------------------
# Imputation and encoding
# --------------------------------------------------------------------------

def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    num = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in num or f.dataType.simpleString().startswith("decimal")
            if f.name not in exclude]


def column_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians of ``cols`` in one distributed pass (one row returned)."""
    return quantile_row(df, {c: (c, 0.5) for c in cols}) if cols else {}


def medians_of_stored(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """:func:`column_medians` of a frame that is stored: read in several passes
    instead of shuffling the values of every column."""
    return stored_medians(df, cols).first().asDict() if cols else {}


def fill_medians(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Replace NULLs by the given medians (all-NULL columns stay NULL)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType))
                           if m is not None and df.schema[c].dataType.simpleString() in ("double", "float")
                           else F.coalesce(F.col(c).cast("double"), F.lit(m))
                           for c, m in medians.items() if m is not None})


def impute_median(df: DataFrame, cols: list[str] | None = None, exclude=()) -> DataFrame:
    """Global median imputation of numeric columns."""
    cols = cols if cols is not None else numeric_columns(df, exclude)
    return fill_medians(df, column_medians(df, cols))


def impute_train(df: DataFrame, is_train: Column, cols: list[str]) -> DataFrame:
    """Medians from the train rows only, applied to every row."""
    return fill_medians(df, column_medians(df.filter(is_train), cols))


def fill_medians_by(df: DataFrame, is_train: Column, cols: list[str], by: str) -> DataFrame:
    """Medians of each group's train rows (few groups of a stored frame), applied
    to all its rows; a column without a value in a group's train rows stays as
    it is."""
    medians = stored_medians(df.filter(is_train), cols, by).withColumnsRenamed({c: f"_m{i}" for i, c in enumerate(cols)})
    j = df.join(medians, by, "left")
    return j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m{i}")) for i, c in enumerate(cols)}).drop(*[f"_m{i}" for i in range(len(cols))])


def label_encoding(df: DataFrame, cols: list[str], max_levels: int = 100,
                   unknown: str = "Unknown") -> dict[str, list[str]]:
    """Fitted label sets: NULL read as ``unknown``, which is always reserved;
    columns with ``max_levels`` or more distinct values are dropped.

    One pass over the rows: a task keeps the levels of all columns and adds
    none to a column that has ``max_levels`` (it is dropped in any case), so
    a task sends at most ``max_levels`` rows a column, however many values an
    id-like column has.  The bounded sets are collected (as Spark's
    ``StringIndexer`` does)."""
    if not cols:
        return {}

    def levels(batches):
        seen: list[set] = [set() for _ in cols]
        for batch in batches:
            for have, column in zip(seen, batch.columns, strict=True):
                if len(have) < max_levels:
                    have.update(islice(set(column.unique().to_pylist()) - have, max_levels - len(have)))
        yield pa.RecordBatch.from_arrays([pa.array([i for i, have in enumerate(seen) for _ in have], pa.int32()),
                                          pa.array([v for have in seen for v in have], pa.string())], names=["c", "v"])
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias(f"c{i}") for i, c in enumerate(cols)])
    first = F.row_number().over(Window.partitionBy("c").orderBy("v")) <= max_levels
    rows = filled.mapInArrow(levels, "c int, v string").distinct().withColumn("first", first).where("first").collect()      # bounded
    found: dict[str, set] = {c: set() for c in cols}
    for r in rows:
        found[cols[r["c"]]].add(r["v"])
    return {c: sorted(v | {unknown}) for c, v in found.items() if len(v) < max_levels}


def apply_label_encoding(df: DataFrame, labels: dict[str, list[str]], all_cols: list[str],
                         unknown: str = "Unknown") -> DataFrame:
    """Codes = position in the sorted label set; unseen values map to
    ``unknown``; gated-out columns are dropped."""
    out = df.drop(*[c for c in all_cols if c not in labels])
    new = {}
    for c, labs in labels.items():
        m = F.create_map(*[x for i, v in enumerate(labs) for x in (F.lit(v), F.lit(i))])
        v = F.coalesce(F.col(c).cast("string"), F.lit(unknown))
        new[c] = F.coalesce(m[v], m[F.lit(unknown)]).cast("int")
    return out.withColumns(new)


def label_encode(df: DataFrame, cols: list[str], max_levels: int = 100) -> DataFrame:
    return apply_label_encoding(df, label_encoding(df, cols, max_levels), cols)


# --------------------------------------------------------------------------
# Splits
# --------------------------------------------------------------------------

def split_hash(id_col: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(id_col.cast("string"), F.lit(f"|{seed}")))


def hash_split(id_col: Column, train_frac: float = 0.8, seed: int = 42) -> Column:
    """True for train rows: the first 4 hex digits of ``md5(id|seed)`` below
    ``train_frac * 65536``.  Row-local, so stable under any partitioning."""
    threshold = format(int(round(train_frac * 65536)), "04x")
    return F.substring(split_hash(id_col, seed), 1, 4) < F.lit(threshold)


def stratified_split(df: DataFrame, strata: str, id_col: str, train_frac: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """Exact per-stratum split: the ``ceil(train_frac * n)`` rows with the
    smallest hash of every stratum are train (``is_train``).

    A stratum may hold a large share of all rows, so ranks are not computed
    over whole strata.  A histogram of the hash's first 4 hex digits per
    stratum (at most 65536 buckets each) locates the boundary bucket; only
    rows of that bucket are ranked.
    """
    h = split_hash(F.col(id_col), seed)
    d = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 4))
    hist = d.groupBy(strata, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    w = Window.partitionBy(strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(strata)
    hist = (hist.withColumn("_cum", F.sum("_nb").over(w))
                .withColumn("_k", F.ceil(F.lit(train_frac) * F.sum("_nb").over(tot)))
                .withColumn("_before", F.col("_cum") - F.col("_nb")))
    # boundary bucket: the k-th row falls inside it
    bound = (hist.filter((F.col("_before") < F.col("_k")) & (F.col("_cum") >= F.col("_k")))
                 .select(strata, F.col("_b").alias("_bb"), (F.col("_k") - F.col("_before")).alias("_need")))
    d = d.join(bound, strata, "left")
    in_b = F.col("_b") == F.col("_bb")
    ranked = (d.filter(in_b)
               .withColumn("_r", F.row_number().over(Window.partitionBy(strata).orderBy("_h", id_col)))
               .select(F.col(id_col).alias("_id"), (F.col("_r") <= F.col("_need")).alias("_tr")))
    d = d.join(ranked, d[id_col] == ranked._id, "left")
    is_train = (F.when(F.col("_bb").isNull(), F.lit(False))
                 .when(F.col("_b") < F.col("_bb"), F.lit(True))
                 .when(F.col("_b") > F.col("_bb"), F.lit(False))
                 .otherwise(F.col("_tr")))
    return d.withColumn("is_train", is_train).drop("_h", "_b", "_bb", "_need", "_id", "_tr")


# --------------------------------------------------------------------------
# Outlier filter
# --------------------------------------------------------------------------

def outlier_filter(df: DataFrame, price: str, tier_col: str = "price_tier",
                   tiers=("very_low", "ultra_high")) -> tuple[DataFrame, DataFrame]:
    """Sequential multi-metric filter on the extreme tiers.

    Steps (each quantile computed on the rows surviving the previous step,
    per tier, in one grouped pass): price/sqft in [p5, p95]; sqft/$ <= p95;
    lot <= p98; year in 1900..2025.  NULL comparisons remove the row, as in
    pandas.  Returns ``(kept rows, stats)`` where stats counts removals per
    tier and step.  Other tiers pass through untouched.
    """
    d = stored(target_ratios(df, price), "ratios").withColumn("_removed", F.lit(None).cast("string"))        # every step reads it
    target = F.col(tier_col).isin(list(tiers))

    def step(d, name, wanted, keep):
        live = d.filter(target & F.col("_removed").isNull())
        rows = quantiles(live, [tier_col], wanted).collect()                  # a row for each extreme tier
        th = {c: F.coalesce(F.lit(None).cast("double"), *[F.when(F.col(tier_col) == r[tier_col], F.lit(r[c])) for r in rows]) for c in wanted}
        drop = target & F.col("_removed").isNull() & ~F.coalesce(keep(th), F.lit(False))
        return d.withColumn("_removed", F.when(drop, F.lit(name)).otherwise(F.col("_removed")))

    d = step(d, "price_per_sqft", {"lo": ("price_per_sqft", 0.05), "hi": ("price_per_sqft", 0.95)},
             lambda th: (F.col("price_per_sqft") >= th["lo"]) & (F.col("price_per_sqft") <= th["hi"]))
    d = step(d, "sqft_per_dollar", {"hi": ("sqft_per_dollar", 0.95)}, lambda th: F.col("sqft_per_dollar") <= th["hi"])
    if "lot_sqft" in d.columns:
        d = step(d, "lot_sqft", {"hi": ("lot_sqft", 0.98)}, lambda th: F.col("lot_sqft") <= th["hi"])
    if "year_built" in d.columns:
        yb = F.col("year_built")
        d = d.withColumn("_removed", F.when(target & F.col("_removed").isNull() &
                                            ~F.coalesce((yb >= 1900) & (yb <= 2025), F.lit(False)),
                                            F.lit("year_built")).otherwise(F.col("_removed")))
    stats = (d.filter(target).groupBy(tier_col)
              .agg(F.count(F.lit(1)).alias("original"),
                   *[F.count(F.when(F.col("_removed") == s, 1)).alias(s)
                     for s in ("price_per_sqft", "sqft_per_dollar", "lot_sqft", "year_built")],
                   F.count(F.when(F.col("_removed").isNull(), 1)).alias("final")))
    kept = d.filter(F.col("_removed").isNull()).drop("_removed", "price_per_sqft", "sqft_per_dollar")
    return kept, stats


def outlier_filter_forest(df: DataFrame, price: str, features: list[str], id_col: str, tier_col: str = "price_tier",
                          tiers=("very_low", "ultra_high"), contamination: float = 0.05, min_rows: int = 100,
                          min_features: int = 3) -> tuple[DataFrame, DataFrame]:
    """:func:`outlier_filter`, then an isolation forest in each extreme tier
    that still has ``min_rows`` rows, over the features that df has (at least
    ``min_features``).  Adds ``isolation_forest``, ``total_removed`` and
    ``pct_removed`` to the statistics."""
    from propval.operators.iforest import isolation_forest
    kept, stats = outlier_filter(df, price, tier_col, tiers)
    there = [f for f in features if f in kept.columns]
    sizes = {r[0]: r[1] for r in stats.select(tier_col, "final").collect()}      # one row per extreme tier
    marked = None
    for t in tiers if len(there) >= min_features else ():
        if sizes.get(t, 0) >= min_rows:
            own = isolation_forest(kept.filter(F.col(tier_col) == t), there, id_col, contamination=contamination)
            out = own.filter("is_outlier").select(id_col, F.lit(t).alias(tier_col))
            marked = out if marked is None else marked.unionByName(out)
    if marked is None:
        removed = stats.select(tier_col, F.lit(0).cast("long").alias("isolation_forest"))
    else:
        marked = stored(marked, "outliers")
        kept = kept.join(marked, [id_col, tier_col], "left_anti")
        removed = marked.groupBy(tier_col).agg(F.count("*").alias("isolation_forest"))
    stats = (stats.join(removed, tier_col, "left").fillna(0, subset=["isolation_forest"])
             .withColumn("final", F.col("final") - F.col("isolation_forest"))
             .withColumn("total_removed", F.col("original") - F.col("final"))
             .withColumn("pct_removed", F.try_divide(F.col("total_removed"), F.col("original")) * 100))
    return kept, stats


# --------------------------------------------------------------------------
# Geo clusters and leakage-safe target encoding
# --------------------------------------------------------------------------

def geo_clusters(df: DataFrame, k: int = 8, seed: int = 42, lat="latitude", lon="longitude") -> DataFrame:
    """``geo_cluster`` from k-means on (lat, lon); invalid rows (or fewer
    than k valid rows) get cluster 0."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    if not _has(df, lat, lon):
        return df.withColumn("geo_cluster", F.lit(0))
    valid = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    vdf = df.filter(valid)
    if vdf.limit(k).count() < k:
        return df.withColumn("geo_cluster", F.lit(0))
    va = VectorAssembler(inputCols=[lat, lon], outputCol="_geo", handleInvalid="keep")
    model = KMeans(k=k, seed=seed, featuresCol="_geo", predictionCol="_gc", maxIter=20).fit(va.transform(vdf))
    filled = df.withColumn("_valid", valid).withColumns(
        {"_lat": F.coalesce(F.col(lat), F.lit(0.0)), "_lon": F.coalesce(F.col(lon), F.lit(0.0))})
    va2 = VectorAssembler(inputCols=["_lat", "_lon"], outputCol="_geo")
    scored = model.transform(va2.transform(filled))
    return (scored.withColumn("geo_cluster", F.when(F.col("_valid"), F.col("_gc")).otherwise(0).cast("int"))
                  .drop("_geo", "_valid", "_lat", "_lon", "_gc"))


def cluster_target_stats(df: DataFrame, is_train: Column, price: str, cluster: str = "geo_cluster") -> DataFrame:
    """Cluster mean / median price from train rows only, joined back; clusters
    without train rows get the train median."""
    train = df.filter(is_train)
    stats = agg_with_quantiles(train, [cluster], [F.avg(price).alias("cluster_avg_price")], {"cluster_med_price": (price, 0.5)})
    med = quantile_row(train, {"m": (price, 0.5)})["m"]
    j = df.join(stats, cluster, "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(med)) for c in ("cluster_avg_price", "cluster_med_price")})


def cluster_target_stats_by(df: DataFrame, is_train: Column, price: str, by: str, cluster: str = "geo_cluster") -> DataFrame:
    """Cluster mean / median price within each group, from its train rows only;
    clusters without train rows get the group's train median."""
    train = df.filter(is_train)
    stats = agg_with_quantiles(train, [by, cluster], [F.avg(price).alias("cluster_avg_price")], {"cluster_med_price": (price, 0.5)})
    whole = quantiles(train, [by], {"_med": (price, 0.5)})
    # few groups: as local tables, which rows meet without a shuffle
    stats, whole = (df.sparkSession.createDataFrame(x.toArrow(), x.schema) for x in (stats, whole))
    j = df.join(stats, [by, cluster], "left").join(whole, by, "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.col("_med")) for c in ("cluster_avg_price", "cluster_med_price")}).drop("_med")
