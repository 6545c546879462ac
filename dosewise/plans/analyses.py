"""Epidemiological analyses."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.functions.dates import ALL_BANDS, age_band, age_years, weekday_name
from dosewise.functions.rates import NEVER_REPORTED, frequency_label, percent
from dosewise.operators.latest import facts_in_force
from dosewise.operators.ranking import running_total, share_of_group, top_k_per_group
from dosewise.operators.reshape import first_n_wide, transpose
from dosewise.plans.facts import dose_products, event_products
from dosewise.sources.tables import Tables


def patient_symptoms(t: Tables) -> DataFrame:
    """Every diagnosis with its patient's gender and date of birth."""
    people = t["patient"].select(
        F.col("ssn").alias("patient"), "gender", F.col("birthday").alias("date_of_birth")
    )
    return t["diagnosis"].join(people, "patient").select(
        F.col("patient").alias("ssn"),
        "gender",
        "date_of_birth",
        "symptom",
        F.col("date").alias("diagnosis_date"),
    )


def patient_vaccine_info(t: Tables, max_doses: int = 2) -> DataFrame:
    """Dates and products of each patient's first doses side by side; NULL where fewer.

    All patients appear. Later doses than ``max_doses`` are not shown.
    """
    wide = first_n_wide(
        dose_products(t),
        "patient",
        ["date"],
        {"date": "date", "vaccine_type": "vaccine_type"},
        max_doses,
    )
    return t["patient"].select("ssn").join(wide.withColumnRenamed("patient", "ssn"), "ssn", "left")


def top_symptoms(t: Tables, k: int = 3, genders: Sequence[str] = ("M", "F")) -> DataFrame:
    """The ``k`` symptoms with most diagnoses per gender: ``gender, rank, symptom, n``.

    Diagnoses are counted per patient and symptom before the gender lookup. Equal
    counts rank by symptom name.
    """
    per_patient = t["diagnosis"].groupBy("patient", "symptom").agg(F.count("*").alias("n"))
    people = t["patient"].where(F.col("gender").isin(*genders)).select(
        F.col("ssn").alias("patient"), "gender"
    )
    counts = per_patient.join(people, "patient").groupBy("gender", "symptom").agg(F.sum("n").alias("n"))
    return top_k_per_group(counts, "gender", "n", "symptom", k).select("gender", "rank", "symptom", "n")


def patient_age_group(
    t: Tables, as_of: Date | datetime, age_mode: str = "mean_year", bands: str = "reference"
) -> DataFrame:
    """Patients with the age band they fall in at ``as_of``."""
    age = age_years(F.col("birthday"), as_of, age_mode)
    return t["patient"].withColumn("age_group", age_band(age, bands))


def patient_dose_count(
    t: Tables, as_of: Date | datetime, age_mode: str = "mean_year", bands: str = "reference"
) -> DataFrame:
    """Patients with age band and ``vacc_status``, the number of doses received."""
    taken = (
        t["vaccine_patient"]
        .groupBy(F.col("patient").alias("ssn"))
        .agg(F.count("date").alias("vacc_status"))
    )
    people = patient_age_group(t, as_of, age_mode, bands)
    return people.join(taken, "ssn", "left").na.fill(0, ["vacc_status"])


def coverage_by_age(
    t: Tables, as_of: Date | datetime, age_mode: str = "mean_year", bands: str = "reference"
) -> DataFrame:
    """Percentage of each age band with exactly 0, 1 and 2 doses, bands as columns.

    A band's whole is all its patients, those with more doses included. A cell nobody
    falls in is NULL, and so is a band without patients.
    """
    people = patient_dose_count(t, as_of, age_mode, bands)
    counted = people.groupBy("age_group").agg(
        F.count("*").alias("n_all"),
        *[F.count_if(F.col("vacc_status") == n).alias(f"n{n}") for n in range(3)],
    )
    cells = counted.select(
        "age_group",
        *[
            F.when(F.col(f"n{n}") > 0, F.col(f"n{n}") / F.col("n_all") * 100).alias(f"{n}-vacc")
            for n in range(3)
        ],
    )
    return transpose(cells, "age_group", [f"{n}-vacc" for n in range(3)], "vacc_status", ALL_BANDS)


# Days whose reports are compared with the same doses, about eleven years.
SPAN_DAYS = 4096


def attribute_symptoms(t: Tables, ordered: bool = True) -> DataFrame:
    """Each reported symptom with the patient's last dose before that day, per hospital
    the patient had a dose at: ``patient, hospital, symptom, symptom_date, vacc_date,
    vaccine_type``.

    Reports are cut by date into spans of ``SPAN_DAYS``. An ordered pass per patient and
    hospital, over spans and doses instead of reports, says between which days a dose is the
    last one; then a join by patient and span makes the result and no more rows. Reports
    and doses are distinct by then: what is compared beyond the result are a patient's
    reports and doses within one span, bounded by the calendar. The pass shuffles by patient
    and hospital, and the join can be split for a patient with very many reports. If the
    result is ordered, the join sorts too: rows of a patient then leave together, which
    spares more in their shuffle and order than joining by hash does. If not, the rows
    of a patient at many hospitals are dealt by hospital.
    """
    given = t["vaccine_patient"].distinct()
    doses = dose_products(t.replaced(vaccine_patient=given)).withColumnRenamed("date", "vacc_date")
    first = t["vaccine_patient"].groupBy("patient", "hospital").agg(F.min("date").alias("first_date"))
    reports = t["diagnosis"].select("patient", "symptom", F.col("date").alias("symptom_date")).distinct()
    reports = reports.withColumn("span", F.floor(F.unix_date("symptom_date") / SPAN_DAYS))
    spans = reports.groupBy("patient", "span").agg(F.min("symptom_date").alias("start"), F.max("symptom_date").alias("end"))
    spans = spans.join(first, "patient").where(F.col("first_date") < F.col("end")).drop("first_date")
    last_between = facts_in_force(spans, doses, ["patient", "hospital"], "start", "end", "vacc_date", "until")
    if ordered:
        last_between = last_between.hint("merge")
    after = F.col("vacc_date") < F.col("symptom_date")
    before = F.col("until").isNull() | (F.col("symptom_date") <= F.col("until"))
    found = (
        reports.join(last_between, ["patient", "span"])
        .where(after & before)
        .select("patient", "hospital", "symptom", "symptom_date", "vacc_date", "vaccine_type")
    )
    if ordered:
        return found.orderBy("patient", "symptom_date", "symptom", "hospital")
    return found.repartition("patient", "hospital")


def symptom_labels(t: Tables, types: Sequence[str] | None = None) -> DataFrame:
    """Symptoms with a frequency label per product, '-' where never reported after it.

    The share is of all reports attributed to the product. ``types`` fixes the product
    columns; without it Spark looks up the products that have a report.
    """
    counts = (
        attribute_symptoms(t, ordered=False)
        .groupBy("vaccine_type", "symptom")
        .agg(F.count("*").alias("n"))
    )
    labels = share_of_group(counts, "vaccine_type", "n", "share").select(
        F.col("symptom").alias("name"), "vaccine_type", frequency_label(F.col("share")).alias("label")
    )
    wide = labels.groupBy("name").pivot("vaccine_type", list(types) if types else None)
    wide = wide.agg(F.first("label"))
    products = [c for c in wide.columns if c != "name"]
    return t["symptoms"].join(wide, "name", "left").na.fill(NEVER_REPORTED, products)


def event_participation(t: Tables, ordered: bool = True) -> DataFrame:
    """Patients per event against the size of its batch, in percent.

    Doses are counted per event before the lookup. Events nobody came to are absent; a dose
    without a patient adds nobody.
    """
    attended = t["vaccine_patient"].groupBy("date", "hospital").agg(F.count("patient").alias("num_patient"))
    rows = (
        event_products(t)
        .join(attended, ["date", "hospital"])
        .select(
            "date",
            "hospital",
            F.col("batch").alias("id"),
            "num_of_vacc",
            "num_patient",
            percent(F.col("num_patient"), F.col("num_of_vacc")).alias("participation"),
        )
    )
    return rows.orderBy("date", "hospital") if ordered else rows


def reserve_percentage(t: Tables) -> DataFrame:
    """Share of a batch to reserve per event: mean participation plus one sample
    standard deviation. With a single event there is no deviation and no result."""
    rate = F.col("participation")
    return (
        event_participation(t, ordered=False)
        .agg(F.bround(F.avg(rate), 2).alias("mean"), F.bround(F.stddev_samp(rate), 2).alias("std"))
        .withColumn("reserve", F.col("mean") + F.col("std"))
    )


VACCINATED, TWO_VACCINES = "vaccinated", "two_vaccines"


def cumulative_vaccinated(t: Tables) -> DataFrame:
    """Patients with at least one dose up to each date someone got their first."""
    first = t["vaccine_patient"].groupBy("patient").agg(F.min("date").alias("date"))
    per_day = first.groupBy("date").agg(F.count("patient").alias(VACCINATED))
    return running_total(per_day, "date", VACCINATED).orderBy("date")


def _second_doses(t: Tables, at: str) -> DataFrame:
    if at == "last":
        shots = t["vaccine_patient"].groupBy("patient").agg(
            F.count("patient").alias("shots"), F.max("date").alias("date")
        )
        return shots.where("shots > 1").select("patient", "date")
    if at == "second":
        doses = t["vaccine_patient"].where(F.col("patient").isNotNull()).select("patient", "date")
        wide = first_n_wide(doses, "patient", ["date"], {"date": "date"}, 2)
        return wide.where(F.col("date2").isNotNull()).select("patient", F.col("date2").alias("date"))
    raise ValueError(f"at must be 'last' or 'second', not {at!r}")


def cumulative_fully_vaccinated(t: Tables, at: str = "last") -> DataFrame:
    """Patients with two or more doses up to each date, dated at their last dose
    (``at='second'``: at their second)."""
    per_day = _second_doses(t, at).groupBy("date").agg(F.count("patient").alias(TWO_VACCINES))
    return running_total(per_day, "date", TWO_VACCINES).orderBy("date")


def coverage_series(t: Tables) -> DataFrame:
    """Both curves in long form, ``date, series, n``; each keeps its own dates.

    One pass over the doses gives both dates of every patient.
    """
    per_patient = t["vaccine_patient"].groupBy("patient").agg(
        F.count("patient").alias("shots"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    steps = F.array(
        F.struct(F.lit(VACCINATED).alias("series"), F.col("first").alias("date")),
        F.struct(
            F.lit(TWO_VACCINES).alias("series"),
            F.when(F.col("shots") > 1, F.col("last")).alias("date"),
        ),
    )
    per_day = (
        per_patient.select("patient", F.inline(steps))
        .where(F.col("date").isNotNull())
        .groupBy("date", "series")
        .agg(F.count("patient").alias("n"))
    )
    return running_total(per_day, "date", "n", per=["series"]).orderBy("series", "date")


def contacts(
    t: Tables,
    worker: str | int,
    start: Date,
    end: Date,
    drop_unknown: bool = False,
) -> DataFrame:
    """People a worker may have met at events from ``start`` to ``end``, both included.

    An event counts if the worker has a shift at its hospital on its weekday. Met are
    its patients and the others on that shift, each person once. One (NULL, NULL) row
    says that some event had no patient or no other worker on record;
    ``drop_unknown=True`` leaves it out.

    Ids are made distinct before the name lookup. Doses are cut to the date range at
    the scan; events without a match come from anti joins on distinct keys, so the
    dose table is never the inner side of an outer join.
    """
    day = F.col("date")
    low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
    roster = t["vaccination_shift"]
    own = roster.where(F.col("worker") == worker).select("hospital", "weekday").distinct()
    events = (
        t["vaccination_event"]
        .where(day.between(low, high))
        .select("hospital", "date", weekday_name(day).alias("weekday"))
        .join(own, ["hospital", "weekday"])
    )
    visits = t["vaccine_patient"].where(day.between(low, high))
    others = roster.where(F.col("worker") != worker)
    shifts = events.select("hospital", "weekday").distinct()

    def met(rows: DataFrame, who: str, people: DataFrame) -> DataFrame:
        ids = rows.select(F.col(who).alias("ssn")).distinct()
        names = people.select("ssn", F.col("ssn").alias("known"), "name")
        return ids.join(names, "ssn", "left").select(F.col("known").alias("ssn"), "name")

    def unmatched(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
        ssn, name = t["patient"].schema["ssn"].dataType, t["patient"].schema["name"].dataType
        return rows.join(known.select(*keys).distinct(), keys, "left_anti").select(
            F.lit(None).cast(ssn).alias("ssn"), F.lit(None).cast(name).alias("name")
        )

    patients = met(visits.join(events, ["hospital", "date"], "left_semi"), "patient", t["patient"])
    workers = met(others.join(shifts, ["hospital", "weekday"], "left_semi"), "worker", t["staff"])
    people = patients.union(workers)
    if drop_unknown:
        return people.where(F.col("ssn").isNotNull()).distinct()
    gaps = unmatched(events, visits, ["hospital", "date"]).union(
        unmatched(shifts, others, ["hospital", "weekday"])
    )
    return people.union(gaps).distinct()


def contacts_by_worker(
    t: Tables, workers: DataFrame, start: Date, end: Date, drop_unknown: bool = False
) -> DataFrame:
    """``contacts`` of every worker of ``workers(worker)`` in one job: ``worker, ssn, name``.

    Each of a worker's contacts appears once, and a (NULL, NULL) contact as in ``contacts``.
    """
    day = F.col("date")
    low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
    asked = workers.select("worker").distinct()
    roster = t["vaccination_shift"].select("hospital", "weekday", "worker").distinct()
    held = t["vaccination_event"].where(day.between(low, high)).select(
        "hospital", "date", weekday_name(day).alias("weekday")
    )
    events = held.join(roster.join(asked, "worker"), ["hospital", "weekday"])
    visits = t["vaccine_patient"].where(day.between(low, high)).select("hospital", "date", "patient")
    shifts = events.select("worker", "hospital", "weekday").distinct()
    colleagues = roster.withColumnRenamed("worker", "colleague")
    seen = events.join(visits, ["hospital", "date"])
    with_whom = shifts.join(colleagues, ["hospital", "weekday"]).where("colleague <> worker")

    def met(rows: DataFrame, who: str, people: DataFrame) -> DataFrame:
        ids = rows.select("worker", F.col(who).alias("ssn")).distinct()
        names = people.select("ssn", F.col("ssn").alias("known"), "name")
        return ids.join(names, "ssn", "left").select("worker", F.col("known").alias("ssn"), "name")

    people = met(seen, "patient", t["patient"]).union(met(with_whom, "colleague", t["staff"]))
    if drop_unknown:
        return people.where(F.col("ssn").isNotNull()).distinct()
    ssn, name = (t["patient"].schema[c].dataType for c in ("ssn", "name"))
    alone = [
        events.join(visits.select("hospital", "date").distinct(), ["hospital", "date"], "left_anti"),
        shifts.join(with_whom.select("worker", "hospital", "weekday").distinct(), ["worker", "hospital", "weekday"], "left_anti"),
    ]
    for rows in alone:
        people = people.union(
            rows.select("worker", F.lit(None).cast(ssn).alias("ssn"), F.lit(None).cast(name).alias("name")))
    return people.distinct()


def staff_for_patient(t: Tables, patient: str | int) -> DataFrame:
    """Staff who may have given a patient's doses: those on shift at the hospital on
    the weekday of each dose."""
    doses = t["vaccine_patient"].where(F.col("patient") == patient).select(
        "patient", "date", "hospital", weekday_name(F.col("date")).alias("weekday")
    )
    staff = t["staff"].select(F.col("ssn").alias("worker"), "name", "role")
    return (
        t["vaccination_shift"]
        .join(doses, ["hospital", "weekday"])
        .join(staff, "worker")
        .select("patient", "date", "hospital", F.col("worker").alias("ssn"), "name", "role")
    )
