"""Rounding and labelling of shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of reports from which a symptom counts as (very) common.
VERY_COMMON_FROM = 0.1
COMMON_FROM = 0.05
VERY_COMMON, COMMON, RARE, NEVER_REPORTED = "very common", "common", "rare", "-"


def exact_ratio(part: Column, whole: Column) -> Column:
    """Two-place decimal ratio of two counts, halves rounded away from zero."""
    return F.round(part.cast("decimal(20,0)") / whole.cast("decimal(20,0)"), 2)


def percent(part: Column, whole: Column) -> Column:
    """Two-place percentage on doubles, halves rounded to even."""
    return F.bround(part / whole * 100, 2)


def frequency_label(share: Column) -> Column:
    return (
        F.when(share >= VERY_COMMON_FROM, VERY_COMMON)
        .when(share >= COMMON_FROM, COMMON)
        .otherwise(RARE)
    )
