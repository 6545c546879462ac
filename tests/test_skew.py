"""One key with a third of the rows: whole results, and the hot key on several tasks."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from dosewise import Tables
from dosewise.plans import analyses, facts, reports

N = 60_000


def number(n):
    return F.pmod(F.xxhash64("id"), F.lit(n))


def third(hot, otherwise):
    return F.when(F.col("id") % 3 == 0, hot).otherwise(otherwise)


def day(n):
    return F.date_add(F.lit(date(2000, 1, 1)), n.cast("int"))


@pytest.fixture(scope="module")
def hot(spark):
    def many(n):
        return spark.range(0, n, 1, 8)

    i = F.col("id")
    text = lambda c: c.cast("string")
    zero = F.lit("0")
    return Tables(
        {
            "patient": many(5_000).select(
                text(i).alias("ssn"), F.concat(F.lit("p"), text(i)).alias("name"), day(-i).alias("birthday"),
                F.when(i % 2 == 0, "M").otherwise("F").alias("gender"),
            ),
            "diagnosis": many(N).select(
                third(zero, text(number(5_000))).alias("patient"), F.concat(F.lit("S"), text(i % 7)).alias("symptom"),
                day(i / 3).alias("date"),
            ),
            "hospital": many(200).select(text(i).alias("name"), F.lit("X HELSINKI").alias("address"), text(i).alias("phone")),
            "batch": many(3_000).select(
                text(i).alias("id"), F.lit(100).alias("num_of_vacc"), F.concat(F.lit("V0"), text(i % 3 + 1)).alias("vaccine_type"),
                F.lit("m").alias("manufacturer"), day(i).alias("prod_date"), day(i + 1).alias("exp_date"),
                third(zero, text(i % 200)).alias("hospital"),
            ),
            "vaccination_event": many(6_000).select(
                day(i % 30).alias("date"), text(F.floor(i / 30)).alias("hospital"), third(zero, text(number(3_000))).alias("batch")
            ),
            "vaccine_patient": many(N).select(
                text(number(5_000)).alias("patient"), third(day(F.lit(0)), day(i % 30)).alias("date"),
                third(zero, text(number(200))).alias("hospital"),
            ),
            "transport_log": many(N).select(
                third(zero, text(i % 3_000)).alias("batch"), text(number(100)).alias("dep_hos"), text(number(90)).alias("arr_hos"),
                third(day(F.lit(0)), day(i % 30)).cast("timestamp_ntz").alias("dep_date"),
                day(i % 31).cast("timestamp_ntz").alias("arr_date"),
            ),
            "vaccination_shift": many(N).select(
                third(zero, text(i % 200)).alias("hospital"), F.lit("Wednesday").alias("weekday"), text(number(5_000)).alias("worker")
            ),
            "staff": many(5_000).select(
                text(i).alias("ssn"), text(i).alias("name"), day(i).alias("birthday"), text(i).alias("phone"),
                F.lit("doctor").alias("role"), F.lit(True).alias("vacc_status"), text(i % 200).alias("hospital"),
            ),
        }
    )


@pytest.fixture()
def small_pieces(conf):
    conf(
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_shuffle_partitions="40",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="10k",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="5k",
    )


JOINS = {
    "patient_symptoms": (analyses.patient_symptoms, "patient"),
    "dose_products": (facts.dose_products, "date"),
    "event_products": (facts.event_products, "batch"),
    "batch_location": (reports.batch_location, "batch"),
    "misplaced_batches": (reports.misplaced_batches, "batch"),
    "staff_on_duty": (lambda t: reports.staff_on_duty(t, date(2000, 1, 5), None), "hospital"),
    "staff_by_shift_and_area": (lambda t: reports.staff_by_shift_and_area(t, ordered=False), "shift_hospital"),
}


@pytest.mark.parametrize("hash_limit", ["0", "128m"], ids=["sort", "hash"])
@pytest.mark.parametrize("name", sorted(JOINS))
def test_hot_key_is_split(hot, small_pieces, conf, name, hash_limit):
    conf(spark_sql_adaptive_maxShuffledHashJoinLocalMapThreshold=hash_limit)
    job, key = JOINS[name]
    joins = [s for s in final_plan(job(hot)).splitlines() if "Join(skew=true)" in s]
    assert any(f"[{key}#" in s for s in joins)


def busiest(df, *found_in):
    """Rows of the fullest partition and of all, before anything merges partitions."""
    n = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count"), F.sum("count")).first()
    return n[0], n[1]


@pytest.fixture(scope="module")
def one_patient(hot, spark):
    """A third of all reports and doses are of one patient, who was at every hospital."""
    i = F.col("id")
    doses = spark.range(0, N, 1, 8).select(
        third(F.lit("0"), (i % 5_000).cast("string")).alias("patient"), day(i % 30).alias("date"), (F.floor(i / 30) % 200).cast("string").alias("hospital"))
    reports = spark.range(0, 6_000, 1, 8).select(
        third(F.lit("0"), (i % 5_000).cast("string")).alias("patient"), F.concat(F.lit("S"), (i % 5).cast("string")).alias("symptom"), day(F.lit(20) + i / 5).alias("date"))
    return hot.replaced(vaccine_patient=doses, diagnosis=reports)


@pytest.mark.parametrize("hash_limit", ["0", "128m"], ids=["sort", "hash"])
def test_hot_patient_at_many_hospitals_is_spread(one_patient, small_pieces, conf, spark, hash_limit):
    conf(spark_sql_adaptive_maxShuffledHashJoinLocalMapThreshold=hash_limit, spark_sql_adaptive_coalescePartitions_enabled="false")
    found = analyses.attribute_symptoms(one_patient, ordered=False)
    most, total = busiest(found)
    assert total > 100_000 and most < total / 8
    symptoms = spark.createDataFrame([(f"S{i}", False) for i in range(5)], "name string, critical boolean")
    labels = analyses.symptom_labels(one_patient.replaced(symptoms=symptoms), ["V01", "V02", "V03"])
    for job in (found, labels):
        assert any("Join(skew=true)" in s for s in final_plan(job).splitlines())


def test_hot_hospital_is_spread_over_its_events(hot, small_pieces, conf, spark):
    conf(spark_sql_adaptive_coalescePartitions_enabled="false")
    symptoms = spark.createDataFrame([("S1", True), ("S2", False)], "name string, critical boolean")
    t = hot.replaced(symptoms=symptoms)
    exposed = reports.critical_exposure(t, date(2050, 1, 1), ordered=False)
    most, total = busiest(exposed)
    per_hospital = exposed.groupBy("hospital").count().agg(F.max("count")).first()[0]
    assert per_hospital > total / 4 and most < per_hospital / 3


def test_every_row_of_a_hot_key_is_kept(hot, small_pieces):
    assert analyses.patient_symptoms(hot).count() == N
    assert analyses.patient_symptoms(hot).where("ssn = '0'").count() >= N // 3
    assert facts.dose_products(hot).count() == N
    # All legs of the hot batch leave on one day, except those of its own number.
    log = hot["transport_log"]
    newest = {r.batch: r.at for r in log.groupBy("batch").agg(F.max("dep_date").alias("at")).collect()}
    expected = sum(newest[r.batch] == r.dep_date for r in log.select("batch", "dep_date").collect())
    assert reports.batch_location(hot).count() == expected


def test_hot_patient_sends_one_row_per_task_and_symptom(hot, small_pieces):
    counted = analyses.top_symptoms(hot).collect()
    per_gender = (
        hot["diagnosis"].join(hot["patient"], F.col("patient") == F.col("ssn")).groupBy("gender", "symptom").count()
    )
    best = {(r.gender, r.symptom): r["count"] for r in per_gender.collect()}
    assert all(best[r.gender, r.symptom] == r.n for r in counted) and len(counted) == 6
