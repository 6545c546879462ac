"""Latest rows per key and latest prior fact per probe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The greatest ``by`` of each key, combined before the shuffle: a key with a third
    of the rows sends one row per task."""
    return df.groupBy(*keys).agg(F.max(by).alias(by))


def rows_at(df: DataFrame, newest: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows of ``df`` that carry the ``by`` listed for their key; ties and copies stay.

    ``newest`` has one row per key and may bring more columns along. The join is on key
    *and* date, which spreads a hot key over its dates; adaptive execution broadcasts
    ``newest`` if it turns out small, or splits a date that is still too full. A rank
    over the key would sort every tie of a hot key in one task.
    """
    return df.join(newest, [*keys, by])


def latest_prior(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    probe_date: str,
    fact_date: str,
    carry: Sequence[str],
) -> DataFrame:
    """Each probe with the last fact of its key dated strictly before it.

    Probes without such a fact are left out; both dates and ``carry`` come back.
    Facts and probes go through one window in date order, so no pair of them is ever
    formed. On equal dates the probe sorts first, which makes the test strict.
    Both inputs should be distinct: a group is then bounded by the calendar.
    """
    own = [c for c in probes.columns if c not in (*keys, probe_date)]
    fact = F.struct(F.col(fact_date), *[F.col(c) for c in carry]).alias("_fact")

    def missing(df: DataFrame, names: Sequence[str]) -> list[Column]:
        return [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]

    left = probes.select(
        *keys,
        F.col(probe_date).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(facts.select(fact).schema["_fact"].dataType).alias("_fact"),
        *own,
    )
    right = facts.select(
        *keys, F.col(fact_date).alias("_at"), F.lit(1).alias("_kind"), fact, *missing(probes, own)
    )
    seen = (
        Window.partitionBy(*keys)
        .orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        left.unionByName(right)
        .withColumn("_last", F.last("_fact", ignorenulls=True).over(seen))
        .where("_kind = 0 and _last is not null")
        .select(
            *keys,
            *own,
            F.col("_at").alias(probe_date),
            F.col(f"_last.{fact_date}").alias(fact_date),
            *[F.col(f"_last.{c}").alias(c) for c in carry],
        )
    )


def facts_in_force(
    spans: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    fact_date: str,
    until: str,
) -> DataFrame:
    """For each span of days, the facts of its key that are the last one before some day in
    it: the last dated before ``start``, and those dated from then to before ``end``. A fact
    is in force on the days after ``fact_date`` up to ``until``, the date of the next (NULL:
    there is none); of several with one date, only one is on any day.

    Spans of a key do not overlap, but may share a day; columns other than their dates and
    keys tell them apart and come back, in their order on equal starts. One window in date
    order over both, as for ``latest_prior``; a span sorts before a fact of the same date.
    """
    own = [c for c in spans.columns if c not in (*keys, start)]
    carry = [c for c in facts.columns if c not in keys]
    span = F.struct(*sorted(own, key=end.__eq__)).alias("_span")
    fact = F.struct(*carry).alias("_fact")

    def missing(df: DataFrame, column: Column, name: str) -> Column:
        return F.lit(None).cast(df.select(column).schema[name].dataType).alias(name)

    left = spans.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), span, missing(facts, fact, "_fact"))
    right = facts.select(*keys, F.col(fact_date).alias("_at"), F.lit(1).alias("_kind"), missing(spans, span, "_span"), fact)
    order = Window.partitionBy(*keys).orderBy("_at", "_kind", "_span")
    seen = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by = ", ".join(f"`{k}`" for k in keys)
    following = F.expr(f"lead(if(_kind = 1, _at, null)) ignore nulls over (partition by {by} order by _at, _kind, _span)")
    return (
        left.unionByName(right)
        .select(
            *keys,
            "_at",
            "_kind",
            F.last("_fact", ignorenulls=True).over(seen).alias("_fact"),
            F.last("_span", ignorenulls=True).over(seen).alias("_span"),
            following.alias(until),
        )
        .where(F.col("_fact").isNotNull() & F.when(F.col("_kind") == 1, F.col("_at") < F.col(f"_span.{end}")).otherwise(True))
        .select(*keys, *[F.col(f"_span.{c}").alias(c) for c in own if c != end], *[F.col(f"_fact.{c}").alias(c) for c in carry], until)
    )
