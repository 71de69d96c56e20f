"""Stand-in source tables built from the driver tables.

The reference reads warehouse tables (assessor, census block groups, county
votes, listings, image analysis, address master).  These views imitate their
schemas with deterministic expressions over the TPC-H-like driver tables so
that every operator runs on data that grows with the scale factor.  The
matching DuckDB text lives in ``propval.plans.oracle_fixtures``; both must
change together.

All views are lazy DataFrames.  Grains:

* ``assessor``      one row per order (``orders`` x ``customer`` + line totals)
* ``cbg_*``         one row per 12-character block-group key (``customer``)
* ``votes``         one row per county (``customer``)
* ``image_tags``    one row per line item (one image, one prominent feature)
* ``parsed_output`` one Python-dict string per order (image analysis text)
* ``listings``      one row per order (listing staging)
* ``address``       one row per four consecutive order keys (id arrays)
* ``comments``      one row per document (listing text)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propval.sources.tables import table

# State code per nation key 0..24 (stand-in for SITUSSTATE).
STATE_CODES = ["ca", "tx", "ny", "fl", "il", "pa", "oh", "ga", "wa", "nj",
               "nc", "mi", "az", "ma", "tn", "in", "mo", "md", "wi", "co",
               "mn", "sc", "al", "la", "ky"]
ZONING_CODES = ["R1", "R2", "R3", "C1"]


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _pick(values: list[str], idx0: Column) -> Column:
    """values[idx0] (0-based) as a column expression."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx0 + 1).cast("int"))


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("_qty"),
        # integer cents: exact sums, independent of summation order
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("_ext_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.countDistinct("l_returnflag").alias("_nrf"))


def assessor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessor-like raw table, one row per order; NULLs placed on purpose."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    li = line_totals(spark, sf_dir)
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(li, o.o_orderkey == li.l_orderkey, "left"))
    k, ck, nk, tp = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey"), F.col("o_totalprice")
    sale_date = F.to_date("o_orderdate")
    state = _pick(STATE_CODES, nk)
    lot = F.floor(F.col("_ext_cents") / 1000) + 1
    null_long = F.lit(None).cast("bigint")
    return j.select(
        k.alias("propertyid"),
        F.round(tp * 4, 2).alias("currentsalesprice"),
        sale_date.alias("currentsalerecordingdate"),
        (F.lit(1900) + k % 126).alias("yearbuilt"),
        F.when(k % 3 == 0, null_long).otherwise(F.lit(1950) + k % 70).alias("effectiveyearbuilt"),
        F.when(k % 97 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(25.0) + (ck % 2000).cast("double") / 100).alias("situslatitude"),
        (F.lit(-70.0) - (ck % 5000).cast("double") / 100).alias("situslongitude"),
        F.when(k % 11 == 0, F.upper(state)).otherwise(state).alias("situsstate"),
        F.concat(F.lit("city_"), (ck % 30).cast("string")).alias("situscity"),
        _pad(ck % 100000, 5).alias("situszip5"),
        (nk.cast("bigint") * 1000 + ck % 20).alias("fips"),
        _pad(ck % 50, 6).alias("situscensustract"),
        (F.col("_qty") * 20).alias("sumlivingareasqft"),
        lot.alias("lotsizesqft"),
        F.round(lot / 43560, 4).alias("lotsizeacres"),
        F.col("_n").alias("bedrooms"),
        F.col("_nrf").alias("bathfull"),
        F.when(k % 4 == 0, null_long).otherwise(k % 3).alias("bathspartialnbr"),
        (F.col("_n") + 3).alias("totalrooms"),
        (k % 4).alias("garageparkingnbr"),
        F.when(k % 6 == 0, null_long).otherwise(k % 3).alias("fireplacecode"),
        (ck % 5 + 1).alias("buildingqualitycode"),
        (k % 5 + 1).alias("buildingconditioncode"),
        (ck % 9).alias("stylecode"),
        F.when(k % 5 == 0, k % 3).alias("poolcode"),
        (k % 3 + 1).alias("storiesnbrcode"),
        F.when(k % 2 == 0, k % 4).alias("airconditioningcode"),
        F.when(ck % 3 == 0, F.lit(1)).alias("basementcode"),
        F.when(ck % 3 == 0, (k % 10) * 50).alias("basementfinishedsqft"),
        F.when(k % 10 == 0, k % 2).alias("watercode"),
        F.round(tp * 3, 0).alias("assdtotalvalue"),
        F.round(tp, 0).alias("assdlandvalue"),
        (F.round(tp * 3, 0) - F.round(tp, 0)).alias("assdimprovementvalue"),
        F.round(tp * 1.1, 0).alias("marketvalueland"),
        F.round(tp * 2.2, 0).alias("marketvalueimprovement"),
        F.lit(None).cast("string").alias("topographycode"),
        (k % 7).alias("siteinfluencecode"),
        (ck % 11).alias("exteriorwallscode"),
        F.lit(None).cast("string").alias("roofcovercode"),
        (k % 2 == 1).alias("owneroccupied"),
        F.when(k % 5 == 1, F.lit(None).cast("double")).otherwise(F.round(tp * 3, 2)).alias("prevsalesprice"),
        F.when(k % 5 == 1, F.lit(None).cast("date"))
         .otherwise(F.date_sub(sale_date, (k % 3000).cast("int"))).alias("prevsalerecordingdate"),
        F.concat(F.lit("sub_"), (ck % 40).cast("string")).alias("subdivisionname"),
        _pick(ZONING_CODES, k % 4).alias("zoning"),
        (F.lit(2023) + k % 4).alias("assessedyear"),
        (F.col("_qty") * 22).alias("sumbuildingsqft"),
        F.when(ck % 3 == 0, (k % 10) * 80).alias("sumbasementsqft"),
        ((k % 4) * 250).alias("sumgaragesqft"),
        (F.col("_qty") * 25).alias("sumgrossareasqft"),
    )


def _cbg_key(ck: Column, nk: Column) -> Column:
    """12-character block-group key: state(2) county(3) tract(6) group(1)."""
    return F.concat(_pad(nk, 2), _pad(ck % 20, 3), _pad(ck % 50, 6), (ck % 3).cast("string"))


def _customers(spark, sf_dir, keep: Column | None = None) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    if keep is not None:
        c = c.filter(keep)
    return c.withColumn("census_block_group", _cbg_key(F.col("c_custkey"), F.col("c_nationkey")))


def cbg_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Census block-group tables B15, B03, B20, B19, B25, B01, B23, B17."""
    ck, bal = F.col("c_custkey"), F.col("c_acctbal")
    g = lambda df: df.groupBy("census_block_group")
    out = {}
    out["b15"] = g(_customers(spark, sf_dir)).agg(
        F.sum(ck % 997 + 50).alias("b15002e1"),
        F.sum(F.when(ck % 7 == 0, F.lit(None).cast("bigint")).otherwise(ck % 13)).alias("b15002e15"),
        F.sum(ck % 17).alias("b15002e32"))
    out["b03"] = g(_customers(spark, sf_dir, ck % 11 != 5)).agg(
        F.sum(ck % 500 + 100).alias("b03002e1"),
        F.sum(ck % 300).alias("b03002e3"))
    out["b20"] = g(_customers(spark, sf_dir, ck % 13 != 3)).agg(
        F.avg(bal + 30000).alias("b20002e1"),
        F.avg(bal * 1.2 + 30000).alias("b20002e2"),
        F.avg(bal * 0.8 + 25000).alias("b20002e3"))
    out["b19"] = g(_customers(spark, sf_dir)).agg(
        F.avg(bal * 10 + 60000).alias("b19013e1"))
    out["b25"] = g(_customers(spark, sf_dir, ck % 17 != 2)).agg(
        F.avg(bal * 40 + 300000).alias("b25077e1"),
        F.avg(bal / 10 + 1200).alias("b25064e1"),
        F.sum(ck % 200 + 20).alias("b25003e1"),
        F.sum(ck % 20).alias("b25003e2"),
        F.sum(ck % 200 + 20 - ck % 20).alias("b25003e3"),
        F.sum(ck % 180 + 10).alias("b25002e2"),
        F.sum(ck % 9).alias("b25002e3"))
    out["b01"] = g(_customers(spark, sf_dir)).agg(
        F.avg(ck % 40 + 30).alias("b01002e1"))
    out["b23"] = g(_customers(spark, sf_dir, ck % 19 != 4)).agg(
        F.sum(ck % 400 + 50).alias("b23025e3"),
        F.sum(ck % 23).alias("b23025e5"))
    out["b17"] = g(_customers(spark, sf_dir)).agg(
        F.sum(ck % 100).alias("b17001e1"),
        F.sum(ck % 10).alias("b17001e2"))
    return out


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County votes; ``county_fips`` is numeric, so leading zeros are lost."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    ck = F.col("c_custkey")
    red = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    agg = (c.withColumn("county_fips", F.col("c_nationkey").cast("bigint") * 1000 + ck % 20)
            .groupBy("county_fips")
            .agg(F.sum(F.when(red, ck % 500 + 100).otherwise(ck % 50)).alias("votes_gop"),
                 F.sum(F.when(red, ck % 50).otherwise(ck % 500 + 100)).alias("votes_dem")))
    total = F.col("votes_gop") + F.col("votes_dem")
    return agg.select(
        F.concat(F.lit("county_"), F.col("county_fips").cast("string")).alias("county_name"),
        "county_fips", "votes_gop", "votes_dem",
        total.alias("total_votes"),
        (F.col("votes_gop") / total).alias("per_gop"),
        (F.col("votes_dem") / total).alias("per_dem"),
        (F.col("votes_gop") / total - F.col("votes_dem") / total).alias("per_point_diff"),
        (F.col("votes_dem") - F.col("votes_gop")).alias("dem_margin"),
        (F.col("votes_gop") - F.col("votes_dem")).alias("rep_margin"))


def image_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long image-analysis table: one image per line item, one feature each.

    Line 5 carries a plural spelling and line 6 a hyphenated spelling of the
    part name, so that fuzzy canonicalisation has work to do.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_linestatus")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    ln = F.col("l_linenumber")
    tag = (F.when(ln == 5, F.concat(F.col("p_name"), F.lit("s")))
            .when(ln == 6, F.regexp_replace("p_name", " ", "-")).otherwise(F.col("p_name")))
    return j.select(
        F.col("l_orderkey").alias("property_id"),
        ln.alias("image_idx"),
        F.col("l_partkey").alias("image_part"),
        F.col("l_suppkey").alias("image_supplier"),
        tag.alias("tag"),
        F.when(ln == 3, F.lit(None).cast("double"))
         .otherwise(F.abs(F.round(F.col("l_discount") * 100, 1))).alias("granular_condition_num"),
        F.round(F.col("l_tax") * 50 + 1, 1).alias("high_condition_num"),
        F.when(F.col("l_linestatus") == "O", "Indoor").otherwise("Exterior").alias("image_type"))


def parsed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image analysis as Python-dict text per order (the reference's format).

    Orders with ``key % 50 == 7`` get a truncated (unparseable) string and
    ``key % 50 == 13`` a NULL.
    """
    t = image_tags(spark, sf_dir)
    num = lambda c: F.when(F.col(c).isNull(), F.lit("None")).otherwise(F.col(c).cast("string"))
    # image key: line, part and supplier (line numbers repeat within an order)
    key = F.concat_ws("_", F.col("image_idx").cast("string"), F.col("image_part").cast("string"),
                      F.col("image_supplier").cast("string"))
    entry = F.concat(
        F.lit("'"), key, F.lit("': {'prominent_features': ['"), F.col("tag"),
        F.lit("'], 'image_type': '"), F.col("image_type"),
        F.lit("', 'granular_condition_num': "), num("granular_condition_num"),
        F.lit(", 'high_condition_num': "), num("high_condition_num"),
        F.lit(", 'is_primary': "),
        F.when(F.col("image_idx") == 1, F.lit("True")).otherwise(F.lit("False")),
        F.lit("}"))
    per = (t.groupBy("property_id")
            .agg(F.sort_array(F.collect_list(F.struct("image_idx", "image_part", "image_supplier",
                                                      entry.alias("s")))).alias("_e")))
    text = F.concat(F.lit("{"), F.array_join(F.transform("_e", lambda x: x["s"]), ", "), F.lit("}"))
    k = F.col("property_id")
    return per.select(
        k, F.when(k % 50 == 13, F.lit(None).cast("string"))
            .when(k % 50 == 7, F.concat(F.lit("'"), text)).otherwise(text).alias("parsed_output"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing / AVM input stand-in, one row per order (listing id = order key).

    Carries the listing columns the single-model and router workflows read,
    the leaky assessment columns they drop, and NULLs where the reference
    fills or flags them.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k, ck, tp = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    null_long = F.lit(None).cast("bigint")
    null_dbl = F.lit(None).cast("double")
    return o.select(
        k.alias("cc_list_id"),
        F.when(k % 53 == 0, null_dbl).otherwise(F.round(tp * 4.2, 2)).alias("price"),
        F.to_date("o_orderdate").alias("a_date"),
        _pick(STATE_CODES, ck % 25).alias("state"),
        F.concat(F.lit("city_"), (ck % 30).cast("string")).alias("city"),
        F.concat(F.lit("sub_"), (ck % 150).cast("string")).alias("subdivision"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(_pick(["Single Family", "Condo", "Townhouse", "Multi Family"], ck % 4))
         .alias("property_sub_type"),
        _pad(ck % 20, 3).alias("fips_county_cd"),
        (F.lit(25.0) + (ck % 2000).cast("double") / 100).alias("latitude"),
        (F.lit(-70.0) - (ck % 5000).cast("double") / 100).alias("longitude"),
        (F.lit(1900) + k % 130).alias("year_built"),
        F.when(k % 3 == 0, null_long).otherwise(F.lit(1950) + k % 70).alias("effective_year_built"),
        (k % 4 + 1).alias("bedrooms"),
        (k % 3 + 1).alias("full_baths"),
        F.when(k % 4 == 0, null_long).otherwise(k % 2).alias("half_baths"),
        F.when(k % 9 == 0, null_dbl).otherwise((k % 3000 + 600).cast("double")).alias("gla_sqft"),
        ((ck % 50 + 1) * 1000).cast("double").alias("lot_sqft"),
        (k % 4).alias("garage_spaces"),
        F.when(k % 5 == 0, F.lit("Private")).alias("pool_spa_types"),
        F.when(k % 6 == 0, null_long).otherwise(k % 3).alias("fireplace_count"),
        F.when(k % 3 == 0, null_dbl).otherwise((k % 40 * 10).cast("double")).alias("hoa_fee_amount"),
        (F.lit(2023) + k % 4).alias("assessed_year"),
        F.round(tp * 3, 0).alias("assessed_total_value"),
        (tp * 0.03).alias("tax_amount"),
        (tp * 4).alias("most_recent_sale"),
        (k % 120).alias("mls_days_on_market"))


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address master: id arrays per four consecutive order keys (bounded)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (o.groupBy((F.col("o_orderkey") / 4).cast("bigint").alias("address_id"))
             .agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("mls_ids"),
                  F.array_sort(F.collect_set(F.col("o_custkey").cast("string"))).alias("assessor_ids")))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing text: documents keyed by property id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.col("doc_id").alias("property_id"), F.col("text").alias("public_listing_comments"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed tag sets per property (``property_id, tags``).  No filter is pushed
    below the explode, where it would parse the text a second time."""
    from propval.operators.tags import parse_tags
    return parse_tags(parsed_output(spark, sf_dir)).select("property_id", F.explode(F.array("tags")).alias("tags"))
