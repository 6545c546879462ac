"""Jobs against brute force on random small tables, and layout independence."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dosewise.operators.latest import latest_prior, newest_per_key, rows_at
from dosewise.operators.ranking import running_total, share_of_group, top_k_per_group
from dosewise.operators.reshape import first_n_wide, repeat_rows, transpose
from dosewise.plans import analyses, reports

RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEYS = st.sampled_from(["a", "b", "c"])
DAYS = st.integers(0, 6)


def day(n):
    return str(date(2021, 1, 1) + timedelta(n))


@RELAXED
@given(st.lists(st.tuples(KEYS, DAYS, st.integers(0, 2)), max_size=25))
def test_latest_rows(spark, data):
    df = spark.createDataFrame(data, "k string, at int, v int")
    best = {k: max(a for kk, a, _ in data if kk == k) for k, _, _ in data}
    expected = sorted((k, a, v) for k, a, v in data if a == best[k])
    found = rows_at(df, newest_per_key(df, ["k"], "at"), ["k"], "at")
    assert sorted(map(tuple, found.select("k", "at", "v").collect())) == expected


@RELAXED
@given(st.sets(st.tuples(KEYS, DAYS)), st.sets(st.tuples(KEYS, DAYS, st.integers(0, 2))))
def test_latest_prior(spark, facts, probes):
    f = spark.createDataFrame([(k, d, f"{k}{d}") for k, d in facts], "k string, fd int, tag string")
    p = spark.createDataFrame(list(probes), "k string, pd int, v int")
    expected = []
    for k, d, v in probes:
        earlier = [x for kk, x in facts if kk == k and x < d]
        if earlier:
            expected.append((k, v, d, max(earlier), f"{k}{max(earlier)}"))
    found = latest_prior(p, f, ["k"], "pd", "fd", ["tag"])
    assert found.columns == ["k", "v", "pd", "fd", "tag"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@RELAXED
@given(st.dictionaries(st.tuples(KEYS, DAYS), st.integers(0, 9)), st.integers(1, 4))
def test_first_n_wide(spark, data, n):
    df = spark.createDataFrame([(k, d, v) for (k, d), v in data.items()], "k string, d int, v int")
    grouped = defaultdict(list)
    for (k, d), v in sorted(data.items()):
        grouped[k].append((d, v))
    expected = []
    for k, seen in grouped.items():
        padded = (seen + [(None, None)] * n)[:n]
        expected.append((k, *[d for d, _ in padded], *[v for _, v in padded]))
    found = first_n_wide(df, "k", ["d"], {"d": "d", "v": "v"}, n)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@pytest.mark.parametrize("piece", [1, 3, 256])
def test_repeat_rows(spark, piece):
    df = spark.createDataFrame([("c", 7), ("a", 0), ("b", 1), ("d", 6)], "k string, n bigint")
    expected = ["b"] + ["c"] * 7 + ["d"] * 6
    assert sorted(r.k for r in repeat_rows(df, "n", piece=piece).collect()) == expected
    found = repeat_rows(df, "n", ["k"], piece)
    assert found.columns == ["k"]
    assert [r.k for r in found.collect()] == expected


@RELAXED
@given(st.dictionaries(st.tuples(KEYS, st.sampled_from("xyz")), st.integers(1, 5), min_size=1))
def test_ranking_and_shares(spark, data):
    df = spark.createDataFrame([(g, s, n) for (g, s), n in data.items()], "g string, s string, n int")
    expected = []
    for g in {g for g, _ in data}:
        ranked = sorted((-n, s) for (gg, s), n in data.items() if gg == g)
        expected += [(g, s, -n, i + 1) for i, (n, s) in enumerate(ranked[:2])]
    assert sorted(map(tuple, top_k_per_group(df, "g", "n", "s", 2).collect())) == sorted(expected)
    totals = Counter()
    for (g, _), n in data.items():
        totals[g] += n
    shares = share_of_group(df, "g", "n", "share").collect()
    assert all(r.share == r.n / totals[r.g] for r in shares)


def test_running_total_per_group(spark):
    df = spark.createDataFrame([("x", 2, 5), ("x", 1, 3), ("y", 1, 4)], "s string, d int, n int")
    assert rows(running_total(df, "d", "n", ["s"]), "s", "d", "n") == [("x", 1, 3), ("x", 2, 8), ("y", 1, 4)]


def test_transpose_fixes_its_columns(spark):
    df = spark.createDataFrame([("u", 1.0, 2.0), ("v", 3.0, None)], "label string, a double, b double")
    found = transpose(df, "label", ["a", "b"], "row", ["u", "v", "w"])
    assert rows(found, "row", "u", "v", "w") == [("a", 1.0, 3.0, None), ("b", 2.0, None, None)]


def random_world(seed):
    r = random.Random(seed)
    hospitals, products = ["H1", "H2", "H3"], ["V01", "V02", "V03"]
    people = [f"p{i}" for i in range(12)]
    doses = {(r.choice(people), r.randrange(12)): r.choice(hospitals) for _ in range(40)}
    events = {(d, h) for (_, d), h in doses.items()} | {(20, "H1")}
    return dict(
        vaccine_type=[(v, f"N{v[-1]}", i % 2 + 1, 0, 1) for i, v in enumerate(products)],
        hospital=[(h, "a", h) for h in hospitals],
        batch=[
            (f"b{i}", 5 + i, r.choice(products), "M", "2021-01-01", "2022-01-01", r.choice(hospitals)) for i in range(6)
        ],
        patient=[(p, p, day(-365 * r.randrange(80)), r.choice("MF")) for p in people],
        vaccine_patient=[(p, day(d), h) for (p, d), h in doses.items()],
        vaccination_event=[(day(d), h, f"b{r.randrange(6)}") for d, h in events],
        symptoms=[("ache", False), ("fever", True), ("rash", True)],
        diagnosis=list({(r.choice(people), r.choice(["ache", "fever", "rash"]), day(r.randrange(15))) for _ in range(60)}),
        transport_log=[
            (f"b{r.randrange(6)}", r.choice(hospitals), r.choice(hospitals), f"{day(r.randrange(3))}T00:00:00", f"{day(i)}T00:00:00")
            for i in range(30)
        ],
    )


@pytest.mark.parametrize("days", [1, 2, 5, 4096])
def test_attribution_by_spans_equals_brute_force(tables, monkeypatch, days):
    """Spans cut everywhere, also between doses of one patient and hospital."""
    monkeypatch.setattr(analyses, "SPAN_DAYS", days)
    r = random.Random(days)
    visits = {("a" if r.random() < 0.7 else "b", day(r.randrange(30))): f"H{r.randrange(2)}" for _ in range(40)}
    events = {(d, h): f"b{r.randrange(3)}" for (_, d), h in visits.items()}
    reported = {(r.choice("abc"), r.choice(["fever", "rash", "ache"]), day(r.choice([3, 4, r.randrange(35)]))) for _ in range(150)}
    t = tables(
        batch=[(f"b{i}", 10, f"V0{i}", "M", day(0), day(9), "H0") for i in range(3)],
        vaccination_event=[(*k, b) for k, b in events.items()],
        vaccine_patient=[(*k, h) for k, h in visits.items()],
        diagnosis=list(reported),
    )
    expected = []
    for p, s, e in reported:
        for h in ("H0", "H1"):
            prior = [d for (q, d), hh in visits.items() if (q, hh) == (p, h) and d < e]
            if prior:
                expected.append((p, h, s, e, max(prior), "V0" + events[max(prior), h][1:]))
    assert len(expected) > 40
    assert rows(analyses.attribute_symptoms(t)) == sorted(expected)


@pytest.mark.parametrize("seed", range(3))
def test_reports_equal_brute_force(tables, seed):
    w = random_world(seed)
    t = tables(**w)
    product_of_batch = {b[0]: b[2] for b in w["batch"]}
    name_of = {v[0]: v[1] for v in w["vaccine_type"]}
    event_batch = {(d, h): b for d, h, b in w["vaccination_event"]}
    doses = [(p, d, h, product_of_batch[event_batch[d, h]]) for p, d, h in w["vaccine_patient"]]

    whole, part = defaultdict(set), defaultdict(set)
    for p, d, _, v in doses:
        whole[name_of[v]].add(p)
        for q, s, e in w["diagnosis"]:
            if q == p and d <= e:
                part[name_of[v], s].add(p)
    expected = {(n, s): round(len(ps) / len(whole[n]) + 1e-9, 2) for (n, s), ps in part.items()}
    found = {(r[0], r[1]): float(r[2]) for r in rows(reports.symptom_frequency(t))}
    assert found == pytest.approx(expected)

    exposure = Counter()
    name = {p[0]: p[1] for p in w["patient"]}
    for p, s, e in w["diagnosis"]:
        if s != "ache" and e > day(5):
            for q, _, h in w["vaccine_patient"]:
                if p == q:
                    for d, hh, b in w["vaccination_event"]:
                        if hh == h:
                            exposure[p, name[p], b, product_of_batch[b], d, h] += 1
    found = reports.critical_exposure(t, date(2021, 1, 6))
    assert Counter(rows(found)) == exposure

    attributed = set()
    for p, s, e in w["diagnosis"]:
        for h in {h for q, _, h, _ in doses if q == p}:
            prior = [(d, v) for q, d, hh, v in doses if (q, hh) == (p, h) and d < e]
            if prior:
                attributed.add((p, h, s, e, *max(prior)))
    assert set(rows(analyses.attribute_symptoms(t))) == attributed

    wide = {r[0]: r[1:] for r in rows(analyses.patient_vaccine_info(t))}
    for p, *_ in w["patient"]:
        seen = (sorted((d, v) for q, d, _, v in doses if q == p) + [(None, None)] * 2)[:2]
        assert wide[p] == (seen[0][0], seen[1][0], seen[0][1], seen[1][1])


@pytest.mark.parametrize("seed", range(2))
def test_curves_rise_to_the_number_of_people(tables, seed):
    w = random_world(seed)
    t = tables(**w)
    shots = Counter(p for p, _, _ in w["vaccine_patient"])
    for curve, total in (
        (analyses.cumulative_vaccinated(t), len(shots)),
        (analyses.cumulative_fully_vaccinated(t), sum(n > 1 for n in shots.values())),
        (analyses.cumulative_fully_vaccinated(t, "second"), sum(n > 1 for n in shots.values())),
    ):
        values = [n for _, n in rows(curve)]
        assert values == sorted(values) and values[-1] == total


def test_stock_total_covers_the_listed_types(tables):
    stock = reports.stock_by_type(tables(**random_world(5)), ("V01", "V02"))
    assert all(r.total_vaccines >= r.V01_amount + r.V02_amount for r in stock.collect())


JOBS = {
    "batch_location": reports.batch_location,
    "misplaced_batches": reports.misplaced_batches,
    "critical_exposure": lambda t: reports.critical_exposure(t, date(2021, 1, 6)),
    "patient_status": reports.patient_status,
    "symptom_frequency": reports.symptom_frequency,
    "attribute_symptoms": analyses.attribute_symptoms,
    "symptom_labels": analyses.symptom_labels,
    "patient_vaccine_info": analyses.patient_vaccine_info,
    "top_symptoms": analyses.top_symptoms,
    "coverage_series": analyses.coverage_series,
}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_layout_does_not_matter(tables, conf, name):
    t = tables(**random_world(9))
    conf(spark_sql_shuffle_partitions="1")
    one = rows(JOBS[name](t))
    shuffled = t.replaced(**{n: df.repartition(5) for n, df in t.items()})
    conf(spark_sql_shuffle_partitions="7", spark_sql_autoBroadcastJoinThreshold="-1")
    assert rows(JOBS[name](shuffled)) == one
    conf(spark_sql_adaptive_enabled="false")
    assert rows(JOBS[name](shuffled)) == one
