"""Violations of declared constraints, as rows.

Each count is the number of rows a database that enforces the rule would refuse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, violations)``: rows that lack a value, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "violations")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def fk_violations(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child keys without a parent, with their row count ``n``. Keys with a NULL pass.

    The child is counted per key before the join, so the join sees every key once
    and a parent that half the child rows point to costs no more than any other.
    """
    present = reduce(and_, [F.col(c).isNotNull() for c in on])
    used = child.where(present).groupBy(*on).agg(F.count("*").alias("n"))
    known = parent.select(*[F.col(p).alias(f"_parent_{c}") for c, p in on.items()])
    match = reduce(and_, [F.col(c) == F.col(f"_parent_{c}") for c in on])
    return used.join(known, match, "left_anti")


def check_violations(df: DataFrame, checks: Sequence[str]) -> DataFrame:
    """Rows failing a check, once per check, named in ``failed``. An unknown (NULL)
    outcome passes, as in SQL."""
    failed = F.array_compact(F.array(*[F.when(~F.expr(c), F.lit(c)) for c in checks]))
    return df.select("*", F.explode(failed).alias("failed"))
