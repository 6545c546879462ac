from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from dosewise import CONTRACTS, Tables, ingest, normalise_headers, rejected_rows, write_table
from dosewise.sources.ingest import reject_counts
from dosewise.sources.sample import as_sheet, sample_tables
from dosewise.sources.tables import read_source

SF = "/root/testdata/sf0.001"


def test_headers_are_stripped_then_renamed_then_lowered(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" batchID", "Location ", "Date"])
    renames = {"batchID": "batch", "location": "never"}
    assert normalise_headers(df, renames, strip=True).columns == ["batch", "location", "date"]
    assert normalise_headers(df, renames).columns == [" batchid", "location ", "date"]


def test_header_with_trailing_blank_is_matched_exactly(spark):
    sheet = spark.createDataFrame(
        [("b", "H1", "H2", "2021-01-02 10:30:00", "2021-01-01T09:00:00", "ignored")],
        ["batchID", "departure ", "arrival", "dateArr", "dateDep", "note"],
    )
    clean = ingest(sheet, CONTRACTS["transport_log"])
    assert clean.schema == CONTRACTS["transport_log"].schema
    assert rows(clean) == [("b", "H1", "H2", "2021-01-01T09:00:00", "2021-01-02T10:30:00")]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="hospital"):
        ingest(spark.createDataFrame([("2021-01-01", "b")], ["date", "batchID"]), CONTRACTS["vaccination_event"])


@pytest.mark.parametrize(
    ("cell", "expected"),
    [("1", True), ("0", False), ("1.0", True), ("0.0", False), ("2", True), ("true", True), (1.0, True), (0, False), (3, True)],
)
def test_numbers_become_flags(spark, cell, expected):
    sheet = spark.createDataFrame([("fever", cell)], ["name", "criticality"])
    assert rows(ingest(sheet, CONTRACTS["symptoms"]), "critical") == [(expected,)]


def test_whole_numbers_only(spark):
    columns = ["id", "name", "doses", "tempMin", "tempMax"]
    sheet = spark.createDataFrame([("V01", "A", "2.0", "-20", "5")], columns)
    assert rows(ingest(sheet, CONTRACTS["vaccine_type"])) == [("V01", "A", 2, -20, 5)]
    with pytest.raises(PySparkException, match="doses"):
        ingest(spark.createDataFrame([("V01", "A", "2.5", "-20", "5")], columns), CONTRACTS["vaccine_type"]).collect()


DIAGNOSES = [
    ("p1", "fever", "2021-03-01"),
    ("p2", "fever", "2021-03-02 00:00:00"),
    ("p3", "fever", "2021-02-29"),
    ("p4", "fever", "soon"),
    ("p5", "fever", "2021"),
    ("p6", "fever", "2021-03"),
    ("p7", "fever", None),
    ("p8", "fever", "44256"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_dates_are_dropped_and_kept_apart(spark, conf, ansi):
    conf(spark_sql_ansi_enabled=ansi)
    sheet = spark.createDataFrame(DIAGNOSES, "Patient string, Symptom string, date string")
    contract = CONTRACTS["diagnosis"]
    assert rows(ingest(sheet, contract)) == [("p1", "fever", "2021-03-01"), ("p2", "fever", "2021-03-02")]
    rejected = rejected_rows(sheet, contract)
    assert rejected.columns == ["patient", "symptom", "date", "bad_columns"]
    assert [r[0] for r in rows(rejected)] == [f"p{i}" for i in range(3, 9)]
    assert all(r.bad_columns == ["date"] for r in rejected.collect())


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["2021-02-29", "soon", "2021-01-01 25:00:00"])
def test_strict_load_stops_on_a_bad_date(spark, conf, ansi, bad):
    conf(spark_sql_ansi_enabled=ansi)
    sheet = spark.createDataFrame([(bad, "H1", "b")], [" date", "location", "batchID"])
    with pytest.raises(PySparkException, match="cannot read as date"):
        ingest(sheet, CONTRACTS["vaccination_event"]).collect()
    assert ingest(sheet, CONTRACTS["vaccination_event"], on_bad="drop").count() == 0


def test_dates_in_another_form(spark):
    sheet = spark.createDataFrame(
        [("p1", "05/10/2021", "H1"), ("p2", "31/02/2021", "H1"), ("p3", "2021-10-05", "H1"), ("p4", None, "H1")],
        "patientSsNo string, date string, location string",
    )
    contract = CONTRACTS["vaccine_patient"]
    assert rows(ingest(sheet, contract, "drop", "dd/MM/yyyy")) == [("p1", "2021-10-05", "H1")]
    assert rows(ingest(sheet, contract, "drop")) == [("p3", "2021-10-05", "H1")]
    assert rows(reject_counts(sheet, contract, "dd/MM/yyyy")) == [(4, 3, 3)]
    assert reject_counts(sheet, contract).columns == ["n_rows", "n_rejected", "bad_date"]
    assert rejected_rows(sheet, contract, "dd/MM/yyyy").count() == 3
    with pytest.raises(PySparkException, match="cannot read as date"):
        ingest(sheet, contract, "fail", "dd/MM/yyyy").collect()


def test_strict_load_parses_a_cell_once(spark):
    sheet = as_sheet(sample_tables(spark, SF)["transport_log"], "transport_log")
    plan = ingest(sheet, CONTRACTS["transport_log"])._jdf.queryExecution().optimizedPlan().toString()
    top = next(s for s in plan.splitlines() if "raise_error" in s)
    assert top.count("raise_error") == 2 and top.count("coalesce(") == 2


def test_a_second_load_adds_nothing(spark, tables, tmp_path):
    root = f"{tmp_path}/stored"
    t = tables(patient=[("a", "Ann", "1990-01-01", "F")], diagnosis=[("a", "fever", "2021-01-01"), (None, "ache", "2021-01-01")])
    t.save(root)
    t.save(root)
    more = t.replaced(patient=tables(patient=[("a", "Ann", "1990-01-01", "F"), ("b", "Bob", "1990-01-01", "M")])["patient"])
    more.save(root)
    stored = Tables.stored(spark, root)
    assert stored["patient"].count() == 2 and stored["diagnosis"].count() == 2


def test_typed_sources_pass_through(spark):
    sheet = spark.createDataFrame(
        [(7, "Ann", datetime(1990, 1, 2, 3, 4), "F")], "ssNo bigint, name string, `date of birth` timestamp_ntz, gender string"
    )
    clean = ingest(sheet, CONTRACTS["patient"])
    assert clean.schema == CONTRACTS["patient"].schema
    assert rows(clean) == [("7", "Ann", "1990-01-02", "F")]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        ingest(spark.createDataFrame([("a", 1)], ["name", "criticality"]), CONTRACTS["symptoms"], on_bad="guess")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_all_sheets_from_files(spark, tmp_path, fmt):
    clean = sample_tables(spark, SF)
    sheets = {}
    for name in ("batch", "staff", "vaccination_event", "transport_log"):
        contract, path = CONTRACTS[name], f"{tmp_path}/{name}"
        writer = as_sheet(clean[name], name).write
        writer = writer.option("header", "true").option("ignoreTrailingWhiteSpace", "false") if fmt == "csv" else writer
        writer.format(fmt).save(path)
        options = {"ignoreTrailingWhiteSpace": "false"} if fmt == "csv" else {}
        sheets[contract.sheet] = read_source(spark, path, fmt, **options)
    loaded = Tables.from_sheets(sheets)
    for name in loaded:
        contract = CONTRACTS[name]
        assert loaded[name].schema == contract.schema
        expected = clean[name].select(*[clean[name][c].cast(contract.schema[c].dataType) for c in contract.columns])
        assert rows(loaded[name]) == rows(expected)


def test_append_and_replace(spark, tmp_path):
    path = f"{tmp_path}/symptoms"
    df = spark.createDataFrame([("fever", True), ("ache", False)], CONTRACTS["symptoms"].schema)
    write_table(df, path)
    write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 4
    write_table(df, path, "overwrite", partition_by=["critical"])
    assert rows(spark.read.parquet(path), "name") == [("ache",), ("fever",)]
    with pytest.raises(ValueError):
        write_table(df, path, "upsert")


def test_stored_tables_round_trip(spark, tables, tmp_path):
    t = tables(patient=[("a", "Ann", "1990-01-01", "F")], symptoms=[("fever", True)])
    t.save(str(tmp_path))
    back = Tables.stored(spark, str(tmp_path))
    assert set(back) == set(CONTRACTS)
    assert rows(back["patient"]) == [("a", "Ann", "1990-01-01", "F")]
    assert all(back[name].schema == CONTRACTS[name].schema for name in back)


def test_tables_are_made_on_first_use(spark):
    made = []

    def make():
        made.append(1)
        return spark.range(1)

    t = Tables({"patient": make})
    assert not made
    assert t["patient"] is t["patient"]
    assert len(made) == 1
    with pytest.raises(ValueError):
        Tables({"people": make})


def test_dates_keep_their_day_in_any_time_zone(spark, conf):
    conf(spark_sql_session_timeZone="America/Sao_Paulo")
    # Midnight of that day did not exist there.
    sheet = spark.createDataFrame([("2018-11-04 00:00:00", "H1", "b")], ["date", "location", "batchID"])
    assert rows(ingest(sheet, CONTRACTS["vaccination_event"]), "date") == [(date(2018, 11, 4).isoformat(),)]
