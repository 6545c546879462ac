"""Operational reports.

Reports that promise an order take ``ordered``: pass False when the result feeds a
table or another job, and no range shuffle is planned. Sort keys go beyond the
promised column, so that one subject's rows can be spread over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.functions.dates import weekday_name
from dosewise.functions.rates import exact_ratio
from dosewise.operators.latest import newest_per_key, rows_at
from dosewise.operators.reshape import conditional_sums, repeat_rows
from dosewise.plans.facts import event_courses, event_products
from dosewise.sources.tables import Tables


def staff_on_duty(
    t: Tables, date: Date = Date(2021, 5, 10), weekday: str | None = "Monday"
) -> DataFrame:
    """Staff with a shift on ``weekday`` where an event takes place on ``date``.

    ``hospital`` is where the shift is. ``weekday=None`` takes the date's own weekday.
    """
    day = F.lit(date).cast("date")
    on_weekday = weekday_name(day) if weekday is None else F.lit(weekday)
    events = t["vaccination_event"].where(F.col("date") == day).select("hospital")
    shifts = t["vaccination_shift"].where(F.col("weekday") == on_weekday)
    staff = t["staff"].select("ssn", "name", "phone", "role", "vacc_status")
    return (
        shifts.join(events, "hospital")
        .join(staff, F.col("worker") == F.col("ssn"))
        .select("ssn", "name", "phone", "role", "vacc_status", "hospital")
    )


def staff_by_shift_and_area(
    t: Tables,
    weekday: str = "Wednesday",
    role: str = "doctor",
    suffix: str = "HELSINKI",
    ordered: bool = True,
) -> DataFrame:
    """Staff of a role with a shift on ``weekday`` in a hospital whose address ends in
    ``suffix`` (case counts). One row per such shift; ``hospital`` is the home hospital."""
    area = t["hospital"].where(F.col("address").endswith(suffix)).select(F.col("name").alias("shift_hospital"))
    shifts = (
        t["vaccination_shift"]
        .where(F.col("weekday") == weekday)
        .select(F.col("hospital").alias("shift_hospital"), "worker")
    )
    staff = t["staff"].where(F.col("role") == role)
    found = shifts.join(area, "shift_hospital").join(staff, F.col("worker") == F.col("ssn"))
    if ordered:
        found = found.orderBy("ssn", "shift_hospital")
    return found.select("ssn", "name", "phone", "role", "vacc_status", "hospital")


def batch_location(t: Tables) -> DataFrame:
    """Where each batch left from and arrived on its last leg, by departure; ties stay."""
    legs = t["transport_log"].select("batch", "dep_hos", "arr_hos", "dep_date")
    newest = newest_per_key(legs, ["batch"], "dep_date")
    return rows_at(legs, newest, ["batch"], "dep_date").select(
        "batch", F.col("dep_hos").alias("last_location"), F.col("arr_hos").alias("current_location")
    )


def misplaced_batches(t: Tables) -> DataFrame:
    """Batches whose last leg ended elsewhere than their hospital, with the phone of the
    hospital that should hold them.

    Home and phone are looked up once per batch, so the log is shuffled once.
    """
    legs = t["transport_log"].select("batch", "arr_hos", "dep_date")
    home = t["batch"].select(F.col("id").alias("batch"), F.col("hospital").alias("correct_location"))
    contact = t["hospital"].select(F.col("name").alias("correct_location"), "phone")
    newest = newest_per_key(legs, ["batch"], "dep_date")
    due = newest.join(home, "batch").join(contact, "correct_location")
    return (
        rows_at(legs, due, ["batch"], "dep_date")
        .where(F.col("arr_hos") != F.col("correct_location"))
        .select("batch", F.col("arr_hos").alias("log_location"), "correct_location", "phone")
    )


PAIRS_PER_TASK = 1 << 16


def _event_buckets(t: Tables, events: DataFrame, pairs_per_task: int) -> DataFrame:
    """``hospital, n_buckets``: into how many tasks the pairs of doses and events of a hospital
    go, from counts of both. Most have one, and nothing of theirs is copied; a bucket keeps two
    events or more, so that copies stay fewer than half the pairs."""
    doses = t["vaccine_patient"].groupBy("hospital").agg(F.count("*").alias("n_doses"))
    held = events.groupBy("hospital").agg(F.count("*").alias("n_events"))
    pairs = F.col("n_doses").cast("double") * F.col("n_events")
    needed = F.least(F.ceil(pairs / pairs_per_task), F.ceil(F.col("n_events") / 2)).cast("int")
    # By number of buckets, so that a join by hospital shuffles anew, and can then be split.
    return doses.join(held, "hospital").select("hospital", needed.alias("n_buckets")).repartition("n_buckets")


def critical_exposure(
    t: Tables,
    after: Date = Date(2021, 5, 10),
    exact_event: bool = False,
    ordered: bool = True,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Batches that patients with a critical symptom after ``after`` may have met.

    A bag: by default a dose counts for every event ever held at its hospital, and a
    patient's rows repeat once per critical diagnosis and dose. ``exact_event=True``
    keeps to the event of the dose's own date.

    Copies travel as a number. Diagnoses and doses are counted per patient before
    they meet, so no join sees a patient with many of both, and rows are written out
    only at the end. By default a hospital's exposed patients all meet all its events:
    events are dealt by date into as many buckets as the hospital's doses times its events
    need, and patients go to each. A hospital with a third of the doses is many tasks' work.
    """
    site = ["hospital", "date"] if exact_event else ["hospital"]
    critical = t["symptoms"].where("critical").select(F.col("name").alias("symptom"))
    diagnoses = (
        t["diagnosis"]
        .where(F.col("date") > F.lit(after).cast("date"))
        .join(critical, "symptom")
        .groupBy("patient")
        .agg(F.count("*").alias("n_diagnoses"))
    )
    doses = t["vaccine_patient"].groupBy("patient", *site).agg(F.count("*").alias("n_doses"))
    people = t["patient"].select(F.col("ssn").alias("patient"), "name")
    exposed = (
        diagnoses.join(people, "patient")
        .join(doses, "patient")
        .select(
            F.col("patient").alias("ssn"),
            "name",
            *site,
            (F.col("n_diagnoses") * F.col("n_doses")).alias("n_copies"),
        )
    )
    events = event_products(t).select("hospital", "date", F.col("batch").alias("id"), "vaccine_type")
    if not exact_event:
        buckets = _event_buckets(t, events, pairs_per_task)
        bucket = F.pmod(F.xxhash64("date"), F.col("n_buckets")).cast("int")
        events = events.join(buckets, "hospital").withColumn("_bucket", bucket).drop("n_buckets")
        every = F.explode(F.sequence(F.lit(0), F.col("n_buckets") - 1))
        exposed = exposed.join(buckets, "hospital").withColumn("_bucket", every).drop("n_buckets")
        site = [*site, "_bucket"]
    order = ["ssn", "date", "hospital"] if ordered else []
    rows = repeat_rows(exposed.join(events, site), "n_copies", order)
    return rows.select("ssn", "name", "id", "vaccine_type", "date", "hospital")


def patient_status(t: Tables, ordered: bool = True) -> DataFrame:
    """Patients with ``vaccinationStatus`` 1 once the course is complete, else 0.

    Complete means at least as many doses as the least demanding product received
    asks for. Every dose counts, also one without a matching event.
    """
    course = event_courses(t).select("date", "hospital", "doses")
    taken = (
        t["vaccine_patient"]
        .join(course, ["date", "hospital"], "left")
        .groupBy(F.col("patient").alias("ssn"))
        .agg(F.count("*").alias("n_doses"), F.min("doses").alias("n_needed"))
    )
    status = (
        t["patient"]
        .join(taken, "ssn", "left")
        .select(
            *t["patient"].columns,
            F.coalesce((F.col("n_doses") >= F.col("n_needed")).cast("int"), F.lit(0)).alias(
                "vaccinationStatus"
            ),
        )
    )
    return status.orderBy("ssn") if ordered else status


def stock_by_type(t: Tables, types: Sequence[str] = ("V01", "V02", "V03")) -> DataFrame:
    """Stock per hospital: all types together, and each of ``types`` on its own.

    Batches are summed before the hospital lookup; hospitals without a batch are absent.
    """
    amount = F.col("num_of_vacc")
    stock = (
        t["batch"]
        .groupBy(F.col("hospital").alias("hospital_name"))
        .agg(
            F.sum(amount).alias("total_vaccines"),
            *conditional_sums(amount, F.col("vaccine_type"), {v: f"{v}_amount" for v in types}),
        )
    )
    known = t["hospital"].select(F.col("name").alias("hospital_name"))
    return stock.join(known, "hospital_name", "left_semi")


def symptom_frequency(t: Tables) -> DataFrame:
    """Share of a product's recipients who reported a symptom on or after a dose of it.

    A patient counts for (product, symptom) exactly if the first dose of the product
    is no later than the last report of the symptom. So both sides shrink to one row
    per patient and product or symptom before they meet, the pairs are unique as they
    are, and neither distinct count needs a shuffle of its own.
    """
    given = event_courses(t).select("date", "hospital", "product")
    first_dose = (
        t["vaccine_patient"]
        .where(F.col("patient").isNotNull())
        .join(given, ["date", "hospital"])
        .groupBy("patient", F.col("product").alias("name"))
        .agg(F.min("date").alias("first_dose"))
    )
    last_report = (
        t["diagnosis"].groupBy("patient", "symptom").agg(F.max("date").alias("last_report"))
    )
    # Counting the date, not the row, keeps both uses of first_dose alike, so that Spark
    # runs it once and reuses its exchange.
    recipients = first_dose.groupBy("name").agg(F.count("first_dose").alias("n_recipients"))
    reporters = (
        first_dose.join(last_report, "patient")
        .where(F.col("first_dose") <= F.col("last_report"))
        .groupBy("name", "symptom")
        .agg(F.count("*").alias("n_reporters"))
    )
    # The report is empty while no patient is registered at all.
    return (
        reporters.where(t["patient"].exists())
        .join(recipients, "name")
        .select(
            "name",
            "symptom",
            exact_ratio(F.col("n_reporters"), F.col("n_recipients")).alias("frequency"),
        )
    )


def create_views(t: Tables) -> None:
    """The tables and ``patient_status`` as session views."""
    t.create_views()
    patient_status(t, ordered=False).createOrReplaceTempView("patient_status")
