"""ANSI-safe arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_pct(num: Column, den: Column) -> Column:
    """``CASE WHEN den > 0 THEN 100.0 * num / den END`` (never divides by 0)."""
    return F.when(den > 0, F.lit(100.0) * num / den)


def ratio_plus_one(num: Column, den: Column) -> Column:
    """``num / (den + 1)`` as double."""
    return num.cast("double") / (den + 1)
