"""Frames several jobs start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.sources.tables import Tables


def event_products(t: Tables) -> DataFrame:
    """Each clinic event with the product of its batch.

    One row per event: events are small beside doses, so the product is looked up
    here once and not on every dose.
    """
    batch = t["batch"].select(F.col("id").alias("batch"), "num_of_vacc", "vaccine_type")
    return t["vaccination_event"].join(batch, "batch")


def event_courses(t: Tables) -> DataFrame:
    """Each clinic event with its product's name and the doses a full course takes."""
    product = t["vaccine_type"].select(
        F.col("id").alias("vaccine_type"), F.col("name").alias("product"), "doses"
    )
    return event_products(t).join(product, "vaccine_type")


def dose_products(t: Tables) -> DataFrame:
    """Each dose with the product given: ``patient, date, hospital, vaccine_type``.

    An event's key is unique, so a dose matches at most one row. A mass event may
    hold a third of the doses; its partition is splittable, as the join is followed
    by a shuffle on another key.
    """
    given = event_products(t).select("date", "hospital", "vaccine_type")
    return t["vaccine_patient"].join(given, ["date", "hospital"]).select(
        "patient", "date", "hospital", "vaccine_type"
    )
