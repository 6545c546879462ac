from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from dosewise.plans import reports

TYPES = [
    ("V01", "Alpha", 1, -10, 5),
    ("V02", "Beta", 2, -10, 5),
    ("V03", "Gamma", 3, -10, 5),
    ("V04", "Delta", 2, -10, 5),
]


def batch(name, product, hospital="H1", amount=10):
    return (name, amount, product, "M", "2021-01-01", "2022-01-01", hospital)


def test_staff_on_duty_uses_the_given_weekday(tables):
    t = tables(
        vaccination_event=[("2021-05-10", "H1", "b"), ("2021-05-11", "H2", "b")],
        vaccination_shift=[
            ("H1", "Monday", "w1"),
            ("H1", "Tuesday", "w2"),
            ("H2", "Monday", "w1"),
            ("H1", "Monday", "w3"),
        ],
        staff=[
            ("w1", "Ann", "1980-01-01", "1", "doctor", True, "H9"),
            ("w2", "Bob", "1980-01-01", "2", "nurse", False, "H1"),
            ("w3", "Cid", "1980-01-01", "3", "nurse", False, "H1"),
        ],
    )
    duty = reports.staff_on_duty(t, date(2021, 5, 10))
    assert duty.columns == ["ssn", "name", "phone", "role", "vacc_status", "hospital"]
    # The shift's hospital, not the home hospital.
    assert rows(duty, "ssn", "hospital") == [("w1", "H1"), ("w3", "H1")]
    assert rows(reports.staff_on_duty(t, date(2021, 5, 10), "Tuesday"), "ssn") == [("w2",)]
    # 2021-05-11 is a Tuesday and no one has a Tuesday shift at H2.
    assert rows(reports.staff_on_duty(t, date(2021, 5, 11), "Monday"), "ssn") == [("w1",)]
    assert rows(reports.staff_on_duty(t, date(2021, 5, 11), None)) == []


def test_staff_by_shift_and_area(tables):
    t = tables(
        hospital=[
            ("H1", "Road 1, HELSINKI", "1"),
            ("H2", "HELSINKI road 2, Espoo", "2"),
            ("H3", "Road 3, Helsinki", "3"),
            ("H4", "Road 4, HELSINKI", "4"),
        ],
        vaccination_shift=[
            ("H1", "Wednesday", "d1"),
            ("H4", "Wednesday", "d1"),
            ("H2", "Wednesday", "d2"),
            ("H3", "Wednesday", "d2"),
            ("H1", "Wednesday", "n1"),
            ("H1", "Monday", "d2"),
        ],
        staff=[
            ("d1", "Ann", "1980-01-01", "1", "doctor", True, "H2"),
            ("d2", "Bob", "1980-01-01", "2", "doctor", True, "H1"),
            ("d3", "Dan", "1980-01-01", "4", "doctor", True, "H1"),
            ("n1", "Cid", "1980-01-01", "3", "nurse", True, "H1"),
        ],
    )
    # One row per matching shift, with the home hospital.
    assert rows(reports.staff_by_shift_and_area(t), "ssn", "hospital") == [("d1", "H2"), ("d1", "H2")]


LOGS = [
    ("b1", "H1", "H2", "2021-01-01T08:00:00", "2021-01-02T08:00:00"),
    ("b1", "H2", "H3", "2021-01-03T08:00:00", "2021-01-03T09:00:00"),
    # A tie on the last departure, and a second arrival of the same leg: all stay.
    ("b1", "H2", "H1", "2021-01-03T08:00:00", "2021-01-03T09:30:00"),
    ("b1", "H2", "H1", "2021-01-03T08:00:00", "2021-01-03T09:40:00"),
    ("b2", "H1", "H2", "2021-01-05T08:00:00", "2021-01-05T09:00:00"),
]


def test_batch_location_keeps_ties_and_copies(tables):
    located = reports.batch_location(tables(transport_log=LOGS))
    assert located.columns == ["batch", "last_location", "current_location"]
    assert rows(located) == [("b1", "H2", "H1"), ("b1", "H2", "H1"), ("b1", "H2", "H3"), ("b2", "H1", "H2")]


def test_misplaced_batches(tables):
    t = tables(
        transport_log=LOGS,
        batch=[batch("b1", "V01", "H3"), batch("b2", "V01", "H2"), batch("b3", "V01", "H1")],
        hospital=[("H1", "a", "p1"), ("H2", "a", "p2"), ("H3", "a", "p3")],
    )
    assert rows(reports.misplaced_batches(t)) == [("b1", "H1", "H3", "p3")] * 2


def exposure_tables(tables):
    return tables(
        patient=[("p1", "Ann", "1990-01-01", "F"), ("p2", "Bob", "1990-01-01", "M"), ("p3", "Cid", "1990-01-01", "M")],
        symptoms=[("fever", False), ("shock", True)],
        diagnosis=[
            ("p1", "shock", "2021-05-11"),
            ("p1", "shock", "2021-05-12"),
            ("p1", "fever", "2021-05-13"),
            # On the limit date, which is excluded.
            ("p2", "shock", "2021-05-10"),
            # Critical, but never vaccinated.
            ("p3", "shock", "2021-05-20"),
        ],
        vaccine_patient=[("p1", "2021-05-01", "H1"), ("p2", "2021-05-01", "H1")],
        vaccination_event=[("2021-05-01", "H1", "b1"), ("2021-05-02", "H1", "b2"), ("2021-05-01", "H2", "b1")],
        batch=[batch("b1", "V01"), batch("b2", "V02")],
    )


def test_critical_exposure_is_a_bag_over_all_events_of_the_hospital(tables):
    t = exposure_tables(tables)
    exposed = reports.critical_exposure(t)
    assert exposed.columns == ["ssn", "name", "id", "vaccine_type", "date", "hospital"]
    assert rows(exposed, "ssn", "id", "date") == [
        ("p1", "b1", "2021-05-01"),
        ("p1", "b1", "2021-05-01"),
        ("p1", "b2", "2021-05-02"),
        ("p1", "b2", "2021-05-02"),
    ]
    assert rows(reports.critical_exposure(t, ordered=False)) == rows(exposed)


def test_critical_exposure_comes_in_order(tables, conf):
    conf(spark_sql_shuffle_partitions="3", spark_sql_adaptive_coalescePartitions_enabled="false")
    t = exposure_tables(tables).replaced(
        diagnosis=tables(diagnosis=[(p, "shock", "2021-06-01") for p in ("p2", "p1")])["diagnosis"]
    )
    assert [r.ssn for r in reports.critical_exposure(t).collect()] == ["p1"] * 2 + ["p2"] * 2


def test_critical_exposure_on_the_exact_event(tables):
    exposed = reports.critical_exposure(exposure_tables(tables), exact_event=True)
    assert rows(exposed, "ssn", "id") == [("p1", "b1"), ("p1", "b1")]


def test_patient_status(tables):
    t = tables(
        vaccine_type=TYPES,
        batch=[batch("b1", "V01"), batch("b2", "V02"), batch("b3", "V03")],
        vaccination_event=[
            ("2021-01-01", "H1", "b1"),
            ("2021-01-02", "H1", "b2"),
            ("2021-01-03", "H1", "b3"),
        ],
        patient=[(p, p, "1990-01-01", "F") for p in ("none", "one", "half", "mixed", "stray", "lost")],
        vaccine_patient=[
            ("one", "2021-01-01", "H1"),
            ("half", "2021-01-02", "H1"),
            # The least demanding of V02 and V03 asks for two doses.
            ("mixed", "2021-01-02", "H1"),
            ("mixed", "2021-01-03", "H1"),
            # A dose without an event counts, but sets no requirement.
            ("stray", "2021-01-02", "H1"),
            ("stray", "2021-02-02", "H1"),
            ("lost", "2021-02-02", "H1"),
        ],
    )
    status = reports.patient_status(t)
    assert status.columns == ["ssn", "name", "birthday", "gender", "vaccinationStatus"]
    assert [r.ssn for r in status.collect()] == sorted(["none", "one", "half", "mixed", "stray", "lost"])
    assert dict(rows(status, "ssn", "vaccinationStatus")) == {
        "none": 0,
        "one": 1,
        "half": 0,
        "mixed": 1,
        "stray": 1,
        "lost": 0,
    }


def test_stock_by_type(tables):
    t = tables(
        hospital=[("H1", "a", "1"), ("H2", "a", "2"), ("H3", "a", "3")],
        batch=[batch("b1", "V01", "H1", 5), batch("b2", "V04", "H1", 7), batch("b3", "V02", "H2", 9)],
    )
    stock = reports.stock_by_type(t)
    assert stock.columns == ["hospital_name", "total_vaccines", "V01_amount", "V02_amount", "V03_amount"]
    assert rows(stock) == [("H1", 12, 5, 0, 0), ("H2", 9, 0, 9, 0)]


def frequency_rows(n_patients=8, with_patients=True):
    people = [f"p{i}" for i in range(n_patients)]
    return dict(
        vaccine_type=TYPES,
        batch=[batch("b1", "V01")],
        vaccination_event=[("2021-01-05", "H1", "b1")],
        patient=[(p, p, "1990-01-01", "F") for p in people] if with_patients else [],
        vaccine_patient=[(p, "2021-01-05", "H1") for p in people],
        diagnosis=[
            # The day of the dose counts, and a patient counts once.
            ("p0", "fever", "2021-01-05"),
            ("p0", "fever", "2021-01-09"),
            ("p1", "ache", "2021-01-04"),
            ("p2", "ache", "2021-01-06"),
            ("p3", "ache", "2021-01-06"),
            ("p4", "ache", "2021-01-06"),
        ],
    )


def test_symptom_frequency_rounds_halves_up(tables):
    frequency = reports.symptom_frequency(tables(**frequency_rows()))
    assert rows(frequency) == [("Alpha", "ache", Decimal("0.38")), ("Alpha", "fever", Decimal("0.13"))]


def test_symptom_frequency_needs_a_registered_patient(tables):
    assert rows(reports.symptom_frequency(tables(**frequency_rows(with_patients=False)))) == []


def test_symptom_frequency_groups_products_by_name(tables):
    data = frequency_rows()
    data["vaccine_type"] = TYPES + [("V05", "Alpha", 2, 0, 1)]
    data["batch"].append(batch("b5", "V05"))
    data["vaccination_event"].append(("2021-01-20", "H1", "b5"))
    data["vaccine_patient"].append(("p0", "2021-01-20", "H1"))
    assert ("Alpha", "fever", Decimal("0.13")) in rows(reports.symptom_frequency(tables(**data)))


def test_views_answer_sql(spark, tables):
    t = exposure_tables(tables)
    reports.create_views(t)
    counted = spark.sql("select count(*) n, sum(vaccinationStatus) s from patient_status").collect()[0]
    assert (counted.n, counted.s) == (3, 0)
    assert spark.sql("select * from batch where vaccine_type = 'V02'").count() == 1


@pytest.mark.parametrize("report", [reports.patient_status, reports.critical_exposure])
def test_unordered_reports_plan_no_range_shuffle(tables, report):
    from conftest import planned

    t = exposure_tables(tables)
    assert "rangepartitioning" in planned(report(t))
    assert "rangepartitioning" not in planned(report(t, ordered=False))
