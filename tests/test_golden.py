"""Golden values hand-checked from the reference's sample extract rows."""

from pyspark.sql import functions as F

from propval.functions.mathx import guarded_pct
from propval.functions import tiers


def test_rates_and_wealth_index(spark):
    df = spark.createDataFrame([(2091, 101, 3520, 101, 112247.667, 6193)],
                               "occ long, vac long, emp long, unemp long, income double, pop long")
    r = df.select(guarded_pct(F.col("vac"), F.col("occ") + F.col("vac")).alias("vacancy"),
                  guarded_pct(F.col("unemp"), F.col("emp") + F.col("unemp")).alias("unemployment"),
                  (F.col("income") * F.col("pop") / 1000000.0).alias("wealth")).first()
    assert round(r.vacancy, 6) == 4.607664
    assert round(r.unemployment, 6) == 2.789285
    assert round(r.wealth, 4) == 695.1498


def test_guarded_pct_zero_denominator_under_ansi(spark):
    df = spark.createDataFrame([(5, 0), (1, 4)], "n long, d long")
    out = [r[0] for r in df.select(guarded_pct(F.col("n"), F.col("d"))).collect()]
    assert out == [None, 25.0]


def test_tier_assignment_is_total_and_disjoint(spark):
    prices = [0.0, 199999.99, 200000.0, 849999.0, 850000.0, 1499999.0, 1500000.0, 5e7, None]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    got = [r[0] for r in df.select(tiers.price_tier(F.col("p"))).collect()]
    assert got == ["very_low", "very_low", "low", "high", "very_high", "very_high", "ultra_high",
                   "ultra_high", "ultra_high"]
    pooled = [r[0] for r in df.select(tiers.price_tier(F.col("p"), tiers.PRICE_TIERS_POOLED)).collect()]
    assert pooled[5] == "ultra_high"


def test_right_closed_cut_and_left_closed_range(spark):
    df = spark.createDataFrame([(100000.0,), (100000.01,), (0.0,), (200000.0,)], "v double")
    cut = [r[0] for r in df.select(tiers.right_closed_cut(F.col("v"))).collect()]
    rng = [r[0] for r in df.select(tiers.left_closed_range(F.col("v"))).collect()]
    assert cut == ["<100K", "100K-200K", None, "100K-200K"]
    assert rng == ["< $200K", "< $200K", "< $200K", "$200K - $500K"]
