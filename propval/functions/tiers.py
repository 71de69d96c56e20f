"""Price tiers and value ranges as column expressions.

Tier tables are plan-time constants; they compile to a ``CASE WHEN`` chain
that stays inside whole-stage codegen (no UDF, no join).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 8 price tiers, [low, high), default 'ultra_high'.
PRICE_TIERS = [
    ("very_low", 0, 200000),
    ("low", 200000, 300000),
    ("lower_mid", 300000, 400000),
    ("mid", 400000, 500000),
    ("upper_mid", 500000, 650000),
    ("high", 650000, 850000),
    ("very_high", 850000, 1500000),
    ("ultra_high", 1500000, math.inf),
]
# The pooled-quantile workflow cuts the top two tiers at 1.2M instead.
PRICE_TIERS_POOLED = PRICE_TIERS[:6] + [("very_high", 850000, 1200000), ("ultra_high", 1200000, math.inf)]
TIER_ORDER = [t[0] for t in PRICE_TIERS]

# 3 router tiers (<200K, <1M, rest), ids 0..2.
ROUTER_TIERS = [(0, "budget", 200000), (1, "mainstream", 1000000), (2, "luxury", math.inf)]

# 4 left-closed reporting ranges [low, high).
RANGES_4 = [(0, 200000, "< $200K"), (200000, 500000, "$200K - $500K"),
            (500000, 1000000, "$500K - $1M"), (1000000, math.inf, "> $1M")]

# 8 right-closed bins (low, high] with labels.
CUT_BINS = [0, 100000, 200000, 300000, 500000, 750000, 1000000, 2000000, 10000000]
CUT_LABELS = ["<100K", "100K-200K", "200K-300K", "300K-500K", "500K-750K", "750K-1M", "1M-2M", ">2M"]


def price_tier(price: Column, tiers=PRICE_TIERS, default: str = "ultra_high") -> Column:
    """First tier with ``low <= price < high``; ``default`` otherwise (also NULL)."""
    expr = None
    for name, lo, hi in tiers:
        cond = price >= lo if math.isinf(hi) else (price >= lo) & (price < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def tier_index(tier: Column, tiers=PRICE_TIERS) -> Column:
    """Position (0-based) of a tier name in the tier table, for ordering."""
    expr = None
    for i, (name, _, _) in enumerate(tiers):
        expr = F.when(tier == name, F.lit(i)) if expr is None else expr.when(tier == name, F.lit(i))
    return expr


def router_tier(price: Column) -> Column:
    """0 below 200K, 1 below 1M, else 2."""
    return F.when(price < 200000, 0).when(price < 1000000, 1).otherwise(2)


def left_closed_range(value: Column, ranges=RANGES_4) -> Column:
    """Label of the ``[low, high)`` range holding ``value``; NULL if none."""
    expr = None
    for lo, hi, label in ranges:
        cond = value >= lo if math.isinf(hi) else (value >= lo) & (value < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def right_closed_cut(value: Column, bins=CUT_BINS, labels=CUT_LABELS) -> Column:
    """``pd.cut`` semantics: label of the ``(b[i], b[i+1]]`` bin; NULL outside."""
    expr = None
    for lo, hi, label in zip(bins[:-1], bins[1:], labels):
        cond = (value > lo) & (value <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
