"""What Spark makes of the jobs, with every table too large to broadcast."""

from __future__ import annotations

import re
from datetime import date

import __spark_entry__ as registry
import pytest
from conftest import final_plan, planned

from dosewise import CONTRACTS, Tables
from dosewise.plans import analyses, reports, validation
from dosewise.sources.sample import sample_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The sample tables as stored contract tables, so that scans show in the plans."""
    root = str(tmp_path_factory.mktemp("tables"))
    sample = sample_tables(spark, SF_DIR)
    Tables(
        {
            name: df.select(*[df[c].cast(CONTRACTS[name].schema[c].dataType) for c in CONTRACTS[name].columns])
            for name, df in sample.items()
        }
    ).save(root)
    return Tables.stored(spark, root)


@pytest.fixture(autouse=True)
def large(conf):
    conf(spark_sql_autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("name", sorted(registry.JOBS))
def test_no_pairwise_join_no_python_no_forced_broadcast(spark, name):
    plan = planned(registry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoop", "BroadcastExchange", "Python", "ArrowEval"):
        assert node not in plan


def line_of(plan, pattern):
    return next(i for i, line in enumerate(plan.splitlines()) if re.search(pattern, line))


def test_scans_read_only_what_they_need(stored):
    plan = planned(reports.batch_location(stored))
    schemas = sorted(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    assert schemas == [
        "batch:string,dep_date:timestamp_ntz",
        "batch:string,dep_hos:string,arr_hos:string,dep_date:timestamp_ntz",
    ]


def test_date_filters_reach_the_scan(stored):
    plan = planned(analyses.contacts(stored, "84", date(1998, 1, 1), date(1998, 12, 31)))
    scans = [s for s in plan.splitlines() if "FileScan" in s]
    doses = [s for s in scans if "vaccine_patient" in s or "patient:string,date:date" in s]
    assert doses
    assert all("GreaterThanOrEqual(date,1998-01-01)" in s for s in doses)
    plan = planned(reports.critical_exposure(stored, date(1999, 1, 1)))
    assert "GreaterThan(date,1999-01-01)" in plan


def test_running_totals_see_one_row_per_day(stored):
    for curve in (analyses.cumulative_vaccinated(stored), analyses.cumulative_fully_vaccinated(stored)):
        plan = planned(curve)
        assert plan.count("SinglePartition") == 1
        # Below the single task: the count per date, already complete.
        below = plan.splitlines()[line_of(plan, "SinglePartition") + 1 :]
        assert re.search(r"HashAggregate\(keys=\[date#\d+\], functions=\[count\(", below[0])


def test_first_doses_are_cut_before_the_shuffle(stored):
    plan = planned(analyses.patient_vaccine_info(stored))
    partial, final = line_of(plan, "WindowGroupLimit.*Partial"), line_of(plan, "WindowGroupLimit.*Final")
    shuffle = line_of(plan, r"Exchange hashpartitioning\(patient")
    assert final < shuffle < partial


def test_attribution_does_not_keep_the_layout_by_patient(stored):
    """The join by patient can be split only if nothing above relies on its layout."""
    lines = planned(analyses.attribute_symptoms(stored, ordered=False)).splitlines()
    window = next(i for i, s in enumerate(lines) if "Window [last(" in s)
    union = next(i for i, s in enumerate(lines) if re.search(r"\bUnion\b", s))
    assert any(re.search(r"Exchange hashpartitioning\(patient#\d+, hospital#\d+", s) for s in lines[window:union])


def test_reports_stay_out_of_the_pass_by_hospital(stored):
    """The pass orders doses and spans of reports; a report would go through it once a hospital."""
    lines = planned(analyses.attribute_symptoms(stored, ordered=False)).splitlines()
    window = line_of("\n".join(lines), r"Window \[last\(")
    union = line_of("\n".join(lines), r"\bUnion\b")
    assert not any("symptom#" in s for s in lines[window : union + 2])


def test_validation_reads_every_table_once_and_shuffles_once(stored):
    plan = planned(validation.validate(stored))
    for name in CONTRACTS:
        assert len(re.findall(rf"FileScan parquet.*/{name}\]", plan)) == 1, name
    # The keys, and the totals of two dozen places.
    assert len(re.findall(r"Exchange hashpartitioning\(place#\d+, one#\d+L, other#\d+L", plan)) == 1
    assert plan.count("Exchange hashpartitioning") <= 4


def test_symptom_frequency_runs_first_doses_once(stored):
    plan = final_plan(reports.symptom_frequency(stored))
    assert re.search(r"ReusedExchange \[patient#\d+, product#\d+", plan)


def test_misplaced_batches_shuffle_the_log_once(stored):
    plan = planned(reports.misplaced_batches(stored))
    assert len(re.findall(r"Exchange hashpartitioning\(batch#\d+, dep_date#\d+", plan)) == 2
    lines = plan.splitlines()
    top = next(i for i, s in enumerate(lines) if "SortMergeJoin" in s)
    assert "dep_date" in lines[top]


@pytest.mark.parametrize(
    "job",
    [reports.stock_by_type, analyses.event_participation, analyses.top_symptoms, analyses.patient_dose_count],
    ids=lambda job: job.__name__,
)
def test_facts_are_combined_before_their_first_shuffle(stored, job):
    plan = planned(job(stored, date(2021, 5, 15)) if job is analyses.patient_dose_count else job(stored))
    facts = {"stock_by_type": "num_of_vacc,vaccine_type,hospital", "event_participation": "date,hospital", "top_symptoms": "patient,symptom"}
    pattern = "FileScan parquet.*" + facts.get(job.__name__, "patient,date").replace(",", r"#\d+,") + r"#\d+\]"
    lines = plan.splitlines()
    scan = next(i for i, s in enumerate(lines) if re.search(pattern, s))
    # Going up from the scan, a partial aggregate comes before any exchange.
    above = [s for s in reversed(lines[:scan]) if "HashAggregate" in s or "Exchange" in s]
    assert "partial_" in above[0]
