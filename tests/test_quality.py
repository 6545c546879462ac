import re

from conftest import planned, rows
from pyspark.sql import functions as F

from dosewise import CONTRACTS, Tables
from dosewise.operators import quality
from dosewise.plans import validation
from dosewise.plans.validation import validate

CLEAN = dict(
    vaccine_type=[("V01", "Alpha", 1, -10, 5)],
    manufacturer=[("M", "FI", "1", "V01")],
    hospital=[("H1", "a", "1"), ("H2", "a", "2")],
    batch=[("b1", 10, "V01", "M", "2021-01-01", "2022-01-01", "H1")],
    transport_log=[("b1", "H1", "H2", "2021-01-01T08:00:00", "2021-01-02T08:00:00")],
    staff=[("s1", "Ann", "1980-01-01", "1", "nurse", True, "H1")],
    vaccination_shift=[("H1", "Monday", "s1")],
    vaccination_event=[("2021-05-10", "H1", "b1")],
    patient=[("p1", "Bob", "1990-01-01", "M")],
    vaccine_patient=[("p1", "2021-05-10", "H1")],
    symptoms=[("fever", False)],
    diagnosis=[("p1", "fever", "2021-05-12")],
)


def broken(t):
    return rows(validate(t).where("violations > 0"))


def test_clean_tables_have_no_violations(tables):
    report = validate(tables(**CLEAN))
    assert report.columns == ["table", "constraint", "kind", "violations"]
    assert rows(report.where("violations > 0")) == []
    kinds = dict(rows(report.groupBy("kind").count()))
    n_columns = sum(len(c.columns) for c in CONTRACTS.values())
    # The fifth check is the one-character gender.
    assert kinds == {"not null": n_columns, "primary key": 12, "foreign key": 17, "check": 5}


def test_empty_tables_have_no_violations(tables):
    assert broken(tables()) == []


def test_one_violation_of_each_kind(tables):
    t = tables(
        **{
            **CLEAN,
            "vaccine_type": [("V01", "Alpha", 0, 5, 5)],
            "staff": CLEAN["staff"] * 3 + [("s2", None, "1980-01-01", "1", "nurse", True, "H1")],
            "vaccination_shift": [("H1", "Monday", "s1"), ("H9", "Monday", "s1"), ("H9", "Tuesday", "s1")],
            "vaccine_patient": [("p1", "2021-05-10", "H1"), ("p1", "2021-05-11", "H1")],
            "patient": [("p1", "Bob", "1990-01-01", "MF")],
        }
    )
    assert broken(t) == [
        ("patient", "length(gender) = 1", "check", 1),
        ("staff", "name", "not null", 1),
        ("staff", "ssn", "primary key", 2),
        ("vaccination_shift", "hospital -> hospital", "foreign key", 2),
        ("vaccine_patient", "date, hospital -> vaccination_event", "foreign key", 1),
        ("vaccine_type", "doses > 0", "check", 1),
        ("vaccine_type", "temp_min < temp_max", "check", 1),
    ]


def test_unknown_passes_checks_and_references(tables):
    t = tables(
        **{
            **CLEAN,
            "batch": CLEAN["batch"] + [("b2", None, "V01", "M", None, "2022-01-01", None)],
        }
    )
    assert broken(t) == [
        ("batch", "hospital", "not null", 1),
        ("batch", "num_of_vacc", "not null", 1),
        ("batch", "prod_date", "not null", 1),
    ]


def test_violating_rows(tables):
    t = tables(
        **{**CLEAN, "batch": [("b1", 0, "V01", "M", "2022-01-01", "2021-01-01", "H9")] + CLEAN["batch"]}
    )
    contract = CONTRACTS["batch"]
    assert rows(quality.null_violations(t["batch"], ["id", "hospital"])) == [("hospital", 0), ("id", 0)]
    assert rows(quality.key_violations(t["batch"], contract.key)) == [("b1", 2)]
    assert rows(quality.fk_violations(t["batch"], t["hospital"], {"hospital": "name"})) == [("H9", 1)]
    failed = quality.check_violations(t["batch"], contract.checks)
    assert rows(failed, "id", "failed") == [("b1", "num_of_vacc > 0"), ("b1", "prod_date < exp_date")]


def test_keys_with_missing_cells_stay_apart(tables):
    """A missing cell is no other cell: (x, NULL) and (NULL, x) are different keys."""
    shifts = [("H1", None, "s1"), ("H1", "s1", None), ("H1", None, "s1"), (None, None, None), (None, None, None)]
    found = broken(tables(**{**CLEAN, "vaccination_shift": CLEAN["vaccination_shift"] + shifts}))
    assert ("vaccination_shift", "worker, weekday, hospital", "primary key", 2) in found
    assert ("vaccination_shift", "weekday", "not null", 4) in found


def test_one_key_with_most_rows_and_many_references(tables):
    doses = [("p1", "2021-05-10", "H1")] * 400 + [("p2", "2021-05-10", "H1")] * 300
    found = broken(tables(**{**CLEAN, "vaccine_patient": doses}))
    assert found == [("vaccine_patient", "patient -> patient", "foreign key", 300), ("vaccine_patient", "patient, date", "primary key", 698)]


def test_some_tables_only(tables):
    t = tables(**CLEAN)
    report = validate(Tables({name: t[name] for name in ("staff", "patient", "diagnosis")}))
    assert {r.constraint for r in report.where("kind = 'foreign key'").collect()} == {"patient -> patient"}


def test_keys_that_share_both_halves_are_told_apart(tables, monkeypatch):
    monkeypatch.setattr(validation, "_halves", lambda marked: [F.lit(1).cast("bigint"), F.lit(2).cast("bigint")])
    assert broken(tables(**CLEAN)) == []
    found = broken(tables(**{**CLEAN, "patient": CLEAN["patient"] * 2, "diagnosis": [("p9", "fever", "2021-05-12")]}))
    assert found == [("diagnosis", "patient -> patient", "foreign key", 1), ("patient", "ssn", "primary key", 1)]


def test_a_key_carries_two_counts(tables):
    """Every key has an entry in a task's memory, however many references its table has."""
    lines = [s for s in planned(validate(tables(**CLEAN))).splitlines() if re.search(r"HashAggregate\(keys=\[place#\d+, one", s)]
    assert lines
    for line in lines:
        functions = re.search(r"functions=\[(.*?)\](, output|\))", line)[1]
        assert len(re.findall(r"\b(?:count|min|max|sum)\(", functions)) <= 2
