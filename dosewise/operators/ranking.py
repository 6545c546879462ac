"""Top-k, shares and running totals over already grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(
    df: DataFrame, group: str, by: str, tie_break: str, k: int, rank: str = "rank"
) -> DataFrame:
    """The ``k`` greatest ``by`` of each group; equal values in ``tie_break`` order."""
    order = Window.partitionBy(group).orderBy(F.desc(by), tie_break)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def share_of_group(df: DataFrame, group: str, count: str, into: str) -> DataFrame:
    """``count`` as a share of its group's total, total put back on every row."""
    total = F.sum(count).over(Window.partitionBy(group))
    return df.withColumn(into, F.col(count) / total)


def running_total(df: DataFrame, order: str, value: str, per: Sequence[str] = ()) -> DataFrame:
    """``value`` replaced by its running sum in ``order``.

    Without ``per`` this is a single-task window: give it grouped input, one row per
    calendar day, never raw facts.
    """
    frame = (
        Window.partitionBy(*per)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(value, F.sum(value).over(frame))
