"""Join-key normalisation for FIPS codes and census tracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def county_fips(fips: Column) -> Column:
    """``LEFT(LPAD(TRIM(CAST(fips AS STRING)), 5, '0'), 5)``.

    Numeric FIPS codes lose their leading zero; padding restores it so that
    states 01..09 still match.
    """
    return F.substring(F.lpad(F.trim(fips.cast("string")), 5, "0"), 1, 5)


def state_fips(fips: Column) -> Column:
    return F.substring(county_fips(fips), 1, 2)


def tract_key(fips: Column, tract: Column) -> Column:
    """11-character tract key: padded county FIPS followed by the 6-digit tract."""
    return F.concat(county_fips(fips), F.trim(tract.cast("string")))


def block_group_tract(cbg: Column) -> Column:
    """Tract of a 12-character block-group key (``LEFT(cbg, 11)``)."""
    return F.substring(cbg, 1, 11)
