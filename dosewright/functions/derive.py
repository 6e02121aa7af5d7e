"""Flags, bands and lookups derived from cleaned columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosewright.spec import (
    AGE_BANDS,
    AGE_RANGE,
    FINAL_STATUS,
    INVALID_AGE_BAND,
    OLDEST_AGE_BAND,
    UFS_OF_REGION,
    UNKNOWN_REGION,
)


def age_is_valid(age: Column) -> Column:
    """Three-valued: an unknown age is neither valid nor invalid."""
    return age.between(*AGE_RANGE)


def age_band(age: Column) -> Column:
    """Band of the whole years of ``age``.

    Whole years are cut towards zero, so the limits sit one above the last
    year of a band and -0.5 still counts as 0; comparing the number itself
    avoids an integer cast that could overflow.
    """
    lowest, highest = AGE_RANGE
    band = F.when((age <= lowest - 1) | (age >= highest + 1), F.lit(INVALID_AGE_BAND))
    for last_year, label in AGE_BANDS:
        band = band.when(age < last_year + 1, F.lit(label))
    return band.when(age.isNotNull(), F.lit(OLDEST_AGE_BAND))


def region_of(
    uf: Column,
    ufs_of_region: Mapping[str, Sequence[str]] = UFS_OF_REGION,
    unknown: str = UNKNOWN_REGION,
) -> Column:
    branches = [(uf.isin(*ufs), F.lit(region)) for region, ufs in ufs_of_region.items()]
    first, *rest = branches
    region = F.when(*first)
    for branch in rest:
        region = region.when(*branch)
    return region.otherwise(F.lit(unknown))


def status_is_final(status: Column) -> Column:
    return F.coalesce(F.upper(status) == FINAL_STATUS, F.lit(False))


def is_deleted(deletion_date: Column) -> Column:
    return deletion_date.isNotNull()


def document_is_valid(final: Column, deleted: Column) -> Column:
    return final & ~deleted


def same_municipality(one: Column, other: Column) -> Column:
    return one == other


def is_complete(values: Sequence[Column]) -> Column:
    """All of ``values`` present; false when there is nothing to check."""
    if not values:
        return F.lit(False)
    return reduce(lambda left, right: left & right, [v.isNotNull() for v in values])


def is_true(flag: Column) -> Column:
    """Two-valued reading of a flag that may be null or text."""
    return F.coalesce(flag.try_cast("boolean"), F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, half up, as a double.

    round() settles binary ties differently between engines, this does not.
    """
    return F.floor(F.lit(1e4) * part / whole + F.lit(0.5)) / F.lit(100.0)
