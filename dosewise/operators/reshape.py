"""Long to wide, transposition and bag expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_wide(
    df: DataFrame, key: str, order_by: Sequence[str], values: Mapping[str, str], n: int
) -> DataFrame:
    """One row per key with the first ``n`` rows side by side: ``{source: stem}`` gives
    columns ``stem1 .. stemN``, NULL where the key has fewer rows.

    Spark cuts each task's share of a key to ``n`` rows before the shuffle
    (WindowGroupLimit), and the aggregate reuses the window's partitioning.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    first = df.select(key, *order_by, *[c for c in values if c not in order_by], position.alias("_n"))
    cells = [
        F.max(F.when(F.col("_n") == k, F.col(source))).alias(f"{stem}{k}")
        for source, stem in values.items()
        for k in range(1, n + 1)
    ]
    return first.where(F.col("_n") <= n).groupBy(key).agg(*cells)


def conditional_sums(value: Column, selector: Column, cases: Mapping[str, str]) -> list[Column]:
    """One sum per case (``{case: column name}``) plus zero where a group lacks it."""
    return [
        F.sum(F.when(selector == case, value).otherwise(0)).alias(name) for case, name in cases.items()
    ]


def transpose(df: DataFrame, labels: str, columns: Sequence[str], into: str, wide: Sequence[str]) -> DataFrame:
    """Turn ``columns`` into rows (named in ``into``) and the values of ``labels`` into
    columns. ``wide`` fixes the result's columns; absent labels give NULL."""
    long = df.unpivot(labels, list(columns), into, "_cell")
    return long.groupBy(into).pivot(labels, list(wide)).agg(F.first("_cell"))


def repeat_rows(df: DataFrame, copies: str, order_by: Sequence[str] = (), piece: int = 256) -> DataFrame:
    """Write each row ``copies`` times, in the order of ``order_by`` if given.

    A row is first cut into pieces of at most ``piece`` copies. Ordering shuffles pieces,
    not copies, and spreads a row with very many of them over several tasks.
    """
    size = F.lit(piece).cast("bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, size))
    pieces = df.where(F.col(copies) > 0).withColumn("_start", starts)
    if order_by:
        pieces = pieces.orderBy(*order_by, "_start")
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(size, F.col(copies) - F.col("_start"))))
    return pieces.withColumn("_copy", copy).drop("_start", "_copy", copies)
