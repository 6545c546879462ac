"""DuckDB SQL for every registered query, written apart from the Spark jobs.

``BINDING`` derives the twelve tables from the driver's views; each statement follows
it as one more common table expression. Formulations differ from the jobs on purpose
(join-back instead of window, pairs instead of ordered passes, and so on).
"""

from __future__ import annotations

BINDING = """
WITH vaccine_type AS (
    SELECT concat('V0', r_regionkey + 1) AS id, r_name AS name,
           CAST(1 + r_regionkey % 3 AS INTEGER) AS doses,
           CAST(-10 * (r_regionkey + 1) AS INTEGER) AS temp_min,
           CAST(8 - r_regionkey AS INTEGER) AS temp_max
    FROM region),
manufacturer AS (
    SELECT n_name AS id, r_name AS origin, concat('tel-', n_nationkey) AS phone,
           concat('V0', r_regionkey + 1) AS vaccine_type
    FROM nation JOIN region ON n_regionkey = r_regionkey),
hospital AS (
    SELECT s_suppkey AS name, n_name AS address, concat('tel-', s_suppkey) AS phone
    FROM supplier JOIN nation ON s_nationkey = n_nationkey ),
n_hospitals AS (SELECT count(*) AS n FROM supplier),
batch AS (
    SELECT p_partkey AS id, CAST(p_size + 10 AS INTEGER) AS num_of_vacc,
           concat('V0', p_partkey % 5 + 1) AS vaccine_type,
           concat('NATION_', p_partkey % 25) AS manufacturer,
           DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS prod_date,
           DATE '2002-01-01' + CAST(p_partkey % 365 AS INTEGER) AS exp_date,
           p_partkey % n AS hospital
    FROM part, n_hospitals),
transport_log AS (
    SELECT l_partkey AS batch, (l_suppkey + 1) % n AS dep_hos, l_suppkey AS arr_hos,
           l_shipdate AS dep_date, l_shipdate + INTERVAL 1 DAY AS arr_date
    FROM lineitem, n_hospitals),
patient AS (
    SELECT c_custkey AS ssn, c_name AS name,
           DATE '1930-01-01' + CAST(c_custkey * 7919 % 33238 AS INTEGER) AS birthday,
           CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender
    FROM customer),
vaccine_patient AS (
    SELECT o_custkey AS patient,
           CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS date,
           min(o_orderkey % n) AS hospital
    FROM orders, n_hospitals
    GROUP BY 1, 2),
vaccination_event AS (
    SELECT date, hospital, ((date - DATE '1995-01-01') * 10 + hospital) % (SELECT count(*) FROM part) AS batch
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(o_orderkey % 5 AS INTEGER)
                 + CASE WHEN month(o_orderdate) = 12 THEN 1 ELSE 0 END AS date,
                 o_orderkey % n AS hospital
          FROM orders, n_hospitals
          UNION
          SELECT DATE '1998-12-07' + CAST(k AS INTEGER) AS date, s_suppkey AS hospital
          FROM supplier, range(7) AS w(k))),
diagnosis AS (
    SELECT DISTINCT o_custkey AS patient, concat('S', CAST(floor(sqrt(p_size)) AS INTEGER)) AS symptom,
           CAST(l_shipdate AS DATE) AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
symptoms AS (
    SELECT concat('S', k) AS name, k >= 6 AS critical
    FROM (SELECT CAST(floor(sqrt(p_size)) AS INTEGER) AS k FROM part
          UNION SELECT CAST(floor(sqrt(p_size)) AS INTEGER) + 1 FROM part)),
staff AS (
    SELECT c_custkey AS ssn, c_name AS name,
           DATE '1960-01-01' + CAST(c_custkey % 14000 AS INTEGER) AS birthday,
           concat('tel-', c_custkey) AS phone,
           CASE c_custkey % 3 WHEN 0 THEN 'doctor' WHEN 1 THEN 'nurse' ELSE 'other' END AS role,
           c_acctbal > 0 AS vacc_status, c_custkey % n AS hospital
    FROM customer, n_hospitals),
day_names AS (
    SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                          (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) AS d(k, day_name)),
vaccination_shift AS (
    SELECT hospital, day_name AS weekday, ssn AS worker
    FROM staff JOIN day_names ON k = ssn % 7 OR k = (ssn + 3) % 7)
"""

WORKER = 84
PATIENT = 16

AGED = """
aged AS (SELECT *, floor((DATE '2021-05-15' - birthday) / 365.2425) AS age FROM patient),
banded AS (
    SELECT ssn, name, birthday, gender,
           CASE WHEN age < 10 THEN '0-9' WHEN age < 20 THEN '10-19' WHEN age < 39 THEN '20-39'
                WHEN age BETWEEN 39 AND 58 THEN '40-59' WHEN age >= 60 THEN '60+' ELSE '0' END AS age_group
    FROM aged),
counted AS (
    SELECT b.*, (SELECT count(*) FROM vaccine_patient v WHERE v.patient = b.ssn) AS vacc_status
    FROM banded b)
"""

DOSES = """
doses AS (
    SELECT vp.patient, vp.date, vp.hospital, b.vaccine_type
    FROM vaccine_patient vp
    JOIN vaccination_event ve ON ve.date = vp.date AND ve.hospital = vp.hospital
    JOIN batch b ON b.id = ve.batch)
"""

ATTRIBUTED = (
    DOSES
    + """,
attributed AS (
    SELECT d.patient, v.hospital, d.symptom, d.date AS symptom_date, v.date AS vacc_date, v.vaccine_type
    FROM diagnosis d, doses v WHERE v.patient = d.patient AND v.date < d.date
    QUALIFY row_number() OVER (PARTITION BY d.patient, v.hospital, d.symptom, d.date ORDER BY v.date DESC) = 1)
"""
)

LAST_LEG = """
last_leg AS (
    SELECT *, rank() OVER (PARTITION BY batch ORDER BY dep_date DESC) AS r FROM transport_log)
"""

TURNOUT = """
turnout AS (
    SELECT date, hospital, b.id, b.num_of_vacc, num_patient,
           round_even(num_patient::DOUBLE / b.num_of_vacc * 100, 2) AS participation
    FROM (SELECT date, hospital, count(*) AS num_patient FROM vaccine_patient GROUP BY ALL)
    JOIN vaccination_event e USING (date, hospital) JOIN batch b ON b.id = e.batch)
"""

FIRST_DATES = "(SELECT patient, min(date) AS date FROM vaccine_patient GROUP BY patient)"
LAST_DATES = (
    "(SELECT patient, max(date) AS date FROM vaccine_patient GROUP BY patient HAVING count(*) >= 2)"
)


def _curve(dates: str, name: str) -> str:
    # Every listed date, with the number of patients dated no later.
    return f"""
    SELECT d.date, (SELECT count(*) FROM {dates} p WHERE p.date <= d.date) AS {name}
    FROM (SELECT DISTINCT date FROM {dates}) d"""


def _age_cell(group: str, n: int) -> str:
    total = f"(SELECT count(*) FROM counted WHERE age_group = '{group}')"
    part = f"(SELECT count(*) FROM counted WHERE age_group = '{group}' AND vacc_status = {n})"
    return f"nullif({part}, 0)::DOUBLE / {total} * 100 AS \"{group}\""


def _age_row(n: int) -> str:
    cells = ", ".join(_age_cell(g, n) for g in ("0", "0-9", "10-19", "20-39", "40-59", "60+"))
    return f"SELECT '{n}-vacc' AS vacc_status, {cells}"


def _label(product: str) -> str:
    return f"""
    coalesce((SELECT CASE WHEN x.n >= 0.1 * x.total THEN 'very common'
                          WHEN x.n >= 0.05 * x.total THEN 'common' ELSE 'rare' END
              FROM shares x WHERE x.symptom = s.name AND x.vaccine_type = '{product}'), '-') AS "{product}" """


def _rule(table: str, rule: str, kind: str, count: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{rule}' AS \"constraint\", '{kind}' AS kind, "
        f"CAST(({count}) AS BIGINT) AS violations"
    )


def _not_null(table: str, columns: str) -> list[str]:
    return [
        _rule(table, c, "not null", f"SELECT count(*) FROM {table} WHERE {c} IS NULL") for c in columns.split()
    ]


def _key(table: str, *key: str) -> str:
    names = ", ".join(key)
    return _rule(
        table,
        names,
        "primary key",
        f"SELECT (SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {table}))",
    )


def _fk(table: str, parent: str, **on: str) -> str:
    match = " AND ".join(f"p.{theirs} = c.{own}" for own, theirs in on.items())
    return _rule(
        table,
        f"{', '.join(on)} -> {parent}",
        "foreign key",
        f"SELECT count(*) FROM {table} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})",
    )


def _check(table: str, rule: str) -> str:
    return _rule(table, rule, "check", f"SELECT count(*) FROM {table} WHERE NOT ({rule})")


VALIDATE = " UNION ALL ".join(
    _not_null("vaccine_type", "id name doses temp_min temp_max")
    + [_key("vaccine_type", "id"), _check("vaccine_type", "doses > 0")]
    + [_check("vaccine_type", "temp_min < temp_max")]
    + _not_null("manufacturer", "id origin phone vaccine_type")
    + [_key("manufacturer", "id"), _fk("manufacturer", "vaccine_type", vaccine_type="id")]
    + _not_null("hospital", "name address phone")
    + [_key("hospital", "name")]
    + _not_null("batch", "id num_of_vacc vaccine_type manufacturer prod_date exp_date hospital")
    + [_key("batch", "id"), _check("batch", "num_of_vacc > 0"), _check("batch", "prod_date < exp_date")]
    + [_fk("batch", "vaccine_type", vaccine_type="id"), _fk("batch", "hospital", hospital="name")]
    + [_fk("batch", "manufacturer", manufacturer="id")]
    + _not_null("transport_log", "batch dep_hos arr_hos dep_date arr_date")
    + [_key("transport_log", "batch", "dep_hos", "arr_hos", "dep_date", "arr_date")]
    + [_fk("transport_log", "batch", batch="id"), _fk("transport_log", "hospital", dep_hos="name")]
    + [_fk("transport_log", "hospital", arr_hos="name")]
    + _not_null("staff", "ssn name birthday phone role vacc_status hospital")
    + [_key("staff", "ssn"), _fk("staff", "hospital", hospital="name")]
    + _not_null("vaccination_shift", "hospital weekday worker")
    + [_key("vaccination_shift", "worker", "weekday", "hospital")]
    + [_fk("vaccination_shift", "hospital", hospital="name"), _fk("vaccination_shift", "staff", worker="ssn")]
    + _not_null("vaccination_event", "date hospital batch")
    + [_key("vaccination_event", "date", "hospital")]
    + [_fk("vaccination_event", "hospital", hospital="name"), _fk("vaccination_event", "batch", batch="id")]
    + _not_null("patient", "ssn name birthday gender")
    + [_key("patient", "ssn"), _check("patient", "length(gender) = 1")]
    + _not_null("vaccine_patient", "patient date hospital")
    + [_key("vaccine_patient", "patient", "date")]
    + [_fk("vaccine_patient", "vaccination_event", date="date", hospital="hospital")]
    + [_fk("vaccine_patient", "patient", patient="ssn"), _fk("vaccine_patient", "hospital", hospital="name")]
    + _not_null("symptoms", "name critical")
    + [_key("symptoms", "name")]
    + _not_null("diagnosis", "patient symptom date")
    + [_key("diagnosis", "patient", "symptom", "date")]
    + [_fk("diagnosis", "patient", patient="ssn"), _fk("diagnosis", "symptoms", symptom="name")]
)


def _met(window: str) -> str:
    return f"""
here AS (
    SELECT date, hospital, dayname(date) AS weekday FROM vaccination_event
    WHERE date {window}
      AND (hospital, dayname(date)) IN (SELECT (hospital, weekday) FROM vaccination_shift WHERE worker = {WORKER})),
visitors AS (SELECT date, hospital, patient FROM here JOIN vaccine_patient USING (date, hospital)),
colleagues AS (
    SELECT hospital, weekday, worker FROM here JOIN vaccination_shift USING (hospital, weekday)
    WHERE worker <> {WORKER}),
met AS (
    SELECT ssn, name FROM patient WHERE ssn IN (SELECT patient FROM visitors)
    UNION
    SELECT ssn, name FROM staff WHERE ssn IN (SELECT worker FROM colleagues)
    UNION
    SELECT NULL, NULL FROM here
    WHERE (date, hospital) NOT IN (SELECT (date, hospital) FROM visitors)
       OR (hospital, weekday) NOT IN (SELECT (hospital, weekday) FROM colleagues))
"""


YEAR_1998 = "BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"


def _clean(table: str, *columns: str) -> str:
    """A table as the ingest stores it: ids as text, everything else typed."""
    return f"SELECT {', '.join(columns)} FROM {table}"


def _text(*names: str) -> list[str]:
    return [f"CAST({n} AS VARCHAR) AS {n}" for n in names]


def _on_duty(day: str, weekday: str) -> str:
    return f"""
    SELECT ssn, name, phone, role, vacc_status, s.hospital
    FROM staff JOIN (SELECT worker, hospital FROM vaccination_shift
                     WHERE weekday = {weekday}
                       AND hospital IN (SELECT hospital FROM vaccination_event WHERE date = {day})) s
      ON worker = ssn"""


def _exposure(site: str) -> str:
    return f"""
    SELECT p.ssn, p.name, b.id, b.vaccine_type, e.date, e.hospital
    FROM diagnosis d JOIN symptoms s ON s.name = d.symptom JOIN patient p ON p.ssn = d.patient
    JOIN vaccine_patient v ON v.patient = p.ssn
    JOIN vaccination_event e ON {site}
    JOIN batch b ON b.id = e.batch
    WHERE s.critical AND d.date > DATE '2001-09-20'"""


STATEMENTS = {
    "staff_on_duty": _on_duty("DATE '1995-06-05'", "'Monday'"),
    "staff_on_duty_own_weekday": _on_duty("DATE '1998-03-05'", "dayname(DATE '1998-03-05')"),
    "staff_by_shift_and_area": """
    SELECT w.ssn, w.name, w.phone, w.role, w.vacc_status, w.hospital
    FROM (SELECT worker FROM vaccination_shift
          WHERE weekday = 'Monday'
            AND hospital IN (SELECT name FROM hospital WHERE right(address, 1) = '0')) s
    JOIN (SELECT * FROM staff WHERE role = 'doctor') w ON w.ssn = s.worker""",
    "batch_location": ("SELECT batch, dep_hos AS last_location, arr_hos AS current_location FROM last_leg WHERE r = 1", LAST_LEG),
    "misplaced_batches": (
        """
    SELECT l.batch, l.arr_hos AS log_location, b.hospital AS correct_location, h.phone
    FROM last_leg l JOIN batch b ON b.id = l.batch JOIN hospital h ON h.name = b.hospital
    WHERE l.r = 1 AND l.arr_hos <> b.hospital""",
        LAST_LEG,
    ),
    "critical_exposure": _exposure("e.hospital = v.hospital"),
    "critical_exposure_exact_event": _exposure("e.hospital = v.hospital AND e.date = v.date"),
    "patient_status": (
        """
    SELECT p.*, CASE WHEN (SELECT count(*) FROM vaccine_patient v WHERE v.patient = p.ssn)
                       >= (SELECT min(t.doses) FROM doses d JOIN vaccine_type t ON t.id = d.vaccine_type
                           WHERE d.patient = p.ssn)
                THEN 1 ELSE 0 END AS "vaccinationStatus"
    FROM patient p""",
        DOSES,
    ),
    "stock_by_type": """
    SELECT h.name AS hospital_name, CAST(sum(num_of_vacc) AS BIGINT) AS total_vaccines,
           CAST(coalesce(sum(num_of_vacc) FILTER (vaccine_type = 'V01'), 0) AS BIGINT) AS "V01_amount",
           CAST(coalesce(sum(num_of_vacc) FILTER (vaccine_type = 'V02'), 0) AS BIGINT) AS "V02_amount",
           CAST(coalesce(sum(num_of_vacc) FILTER (vaccine_type = 'V03'), 0) AS BIGINT) AS "V03_amount"
    FROM batch b JOIN hospital h ON h.name = b.hospital GROUP BY h.name""",
    "symptom_frequency": (
        """
    SELECT name, symptom, ((200 * n + whole) // (2 * whole)) / 100.0::DOUBLE AS frequency
    FROM (SELECT name, symptom, count(*) AS n
          FROM (SELECT DISTINCT r.name, r.patient, g.symptom
                FROM received r JOIN diagnosis g ON g.patient = r.patient AND g.date >= r.date)
          GROUP BY ALL)
    JOIN (SELECT name, count(*) AS whole FROM (SELECT DISTINCT name, patient FROM received) GROUP BY ALL)
      USING (name)""",
        DOSES
        + """,
received AS (
    SELECT t.name, d.patient, d.date FROM doses d JOIN vaccine_type t ON t.id = d.vaccine_type)
""",
    ),
    "patient_symptoms": """
    SELECT p.ssn, p.gender, p.birthday AS date_of_birth, d.symptom, d.date AS diagnosis_date
    FROM patient p JOIN diagnosis d ON d.patient = p.ssn""",
    "patient_vaccine_info": (
        """
    SELECT p.ssn, f.date AS date1, s.date AS date2, f.vaccine_type AS vaccine_type1, s.vaccine_type AS vaccine_type2
    FROM patient p
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY date) AS k FROM doses) f
      ON f.patient = p.ssn AND f.k = 1
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY date) AS k FROM doses) s
      ON s.patient = p.ssn AND s.k = 2""",
        DOSES,
    ),
    "top_symptoms": """
    SELECT gender, CAST(row_number() OVER (PARTITION BY gender ORDER BY n DESC, symptom) AS INTEGER) AS rank,
           symptom, n
    FROM (SELECT p.gender, d.symptom, count(*) AS n
          FROM patient p JOIN diagnosis d ON d.patient = p.ssn GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY gender ORDER BY n DESC, symptom) <= 3""",
    "patient_age_group": ("SELECT * FROM banded", AGED),
    "patient_age_group_labelled": """
    SELECT *, CASE WHEN age < 10 THEN '0-9' WHEN age < 20 THEN '10-19' WHEN age < 40 THEN '20-39'
                   WHEN age < 60 THEN '40-59' ELSE '60+' END AS age_group
    FROM (SELECT *, date_diff('year', birthday, DATE '2021-05-15')
                    - CAST(strftime(birthday, '%m%d') > '0515' AS INTEGER) AS age FROM patient)""",
    "patient_dose_count": ("SELECT * FROM counted", AGED),
    "coverage_by_age": (" UNION ALL ".join(_age_row(n) for n in range(3)), AGED),
    "attribute_symptoms": ("SELECT * FROM attributed", ATTRIBUTED),
    "symptom_labels": (
        "SELECT s.name, s.critical," + ",".join(_label(f"V0{k}") for k in range(1, 6)) + "FROM symptoms s",
        ATTRIBUTED
        + """,
shares AS (
    SELECT vaccine_type, symptom, n, (SELECT count(*) FROM attributed a WHERE a.vaccine_type = g.vaccine_type) AS total
    FROM (SELECT vaccine_type, symptom, count(*) AS n FROM attributed GROUP BY ALL) g)
""",
    ),
    "event_participation": ("SELECT * FROM turnout", TURNOUT),
    "reserve_percentage": (
        """
    SELECT mean, std, mean + std AS reserve
    FROM (SELECT round_even(avg(participation), 2) AS mean, round_even(stddev_samp(participation), 2) AS std
          FROM turnout)""",
        TURNOUT,
    ),
    "cumulative_vaccinated": _curve(FIRST_DATES, "vaccinated"),
    "cumulative_fully_vaccinated": _curve(LAST_DATES, "two_vaccines"),
    "cumulative_fully_vaccinated_second": _curve("seconds", "two_vaccines"),
    "coverage_series": f"""
    SELECT date, 'vaccinated' AS series, vaccinated AS n FROM ({_curve(FIRST_DATES, "vaccinated")})
    UNION ALL
    SELECT date, 'two_vaccines' AS series, two_vaccines AS n FROM ({_curve(LAST_DATES, "two_vaccines")})""",
    "contacts": ("SELECT ssn, name FROM met", _met(YEAR_1998)),
    "contacts_known": ("SELECT ssn, name FROM met WHERE ssn IS NOT NULL", _met(YEAR_1998)),
    "contacts_by_worker": """
    SELECT worker, ssn, name FROM each_here JOIN vaccine_patient USING (date, hospital) JOIN patient ON ssn = patient
    UNION
    SELECT e.worker, w.ssn, w.name
    FROM each_here e JOIN vaccination_shift s ON s.hospital = e.hospital AND s.weekday = e.weekday AND s.worker <> e.worker
    JOIN staff w ON w.ssn = s.worker
    UNION
    SELECT worker, NULL, NULL FROM each_here e
    WHERE NOT EXISTS (SELECT 1 FROM vaccine_patient v WHERE v.date = e.date AND v.hospital = e.hospital)
       OR NOT EXISTS (SELECT 1 FROM vaccination_shift s
                      WHERE s.hospital = e.hospital AND s.weekday = e.weekday AND s.worker <> e.worker)""",
    "staff_for_patient": f"""
    SELECT v.patient, v.date, v.hospital, w.ssn, w.name, w.role
    FROM vaccine_patient v JOIN vaccination_shift s
      ON s.hospital = v.hospital AND s.weekday = dayname(v.date)
    JOIN staff w ON w.ssn = s.worker WHERE v.patient = {PATIENT}""",
    "null_violations": """
    SELECT c AS "column", CASE c WHEN 'name' THEN others WHEN 'phone' THEN unvaccinated ELSE 0 END AS violations
    FROM (VALUES ('ssn'), ('name'), ('birthday'), ('phone'), ('role'), ('vacc_status'), ('hospital')) AS t(c),
         (SELECT count(*) FILTER (role = 'other') AS others, count(*) FILTER (NOT vacc_status) AS unvaccinated
          FROM staff)""",
    "key_violations": """
    SELECT batch, dep_hos, arr_hos, dep_date, arr_date, count(*) AS n
    FROM transport_log GROUP BY ALL HAVING count(*) > 1""",
    "fk_violations": """
    SELECT -worker AS worker, count(*) AS n FROM vaccination_shift
    WHERE weekday = 'Sunday' AND worker > 0 GROUP BY worker""",
    "check_violations": """
    SELECT *, 'num_of_vacc > 15' AS failed FROM batch WHERE num_of_vacc <= 15
    UNION ALL
    SELECT *, 'vaccine_type <> ''V05''' AS failed FROM batch WHERE vaccine_type = 'V05'""",
    "validate": VALIDATE,
    "ingest_vaccine_type": "SELECT * FROM vaccine_type",
    "ingest_manufacturer": "SELECT * FROM manufacturer",
    "ingest_hospital": _clean("hospital", *_text("name"), "address", "phone"),
    "ingest_batch": _clean(
        "batch", *_text("id", "hospital"), "num_of_vacc", "vaccine_type", "manufacturer", "prod_date", "exp_date"
    ),
    "ingest_transport_log": _clean(
        "transport_log", *_text("batch", "dep_hos", "arr_hos"), "dep_date", "arr_date"
    ),
    "ingest_staff": _clean(
        "staff", *_text("ssn", "hospital"), "name", "birthday", "phone", "role", "vacc_status"
    ),
    "ingest_vaccination_shift": _clean("vaccination_shift", *_text("hospital", "worker"), "weekday"),
    "ingest_vaccination_event": _clean("vaccination_event", *_text("hospital", "batch"), "date"),
    "ingest_patient": _clean("patient", *_text("ssn"), "name", "birthday", "gender"),
    "ingest_vaccine_patient": _clean("vaccine_patient", *_text("patient", "hospital"), "date"),
    "ingest_symptoms": "SELECT * FROM symptoms",
    "ingest_diagnosis": _clean("diagnosis", *_text("patient"), "symptom", "date") + " WHERE symptom NOT IN ('S1', 'S2')",
    "rejected_diagnosis": """
    SELECT CAST(patient AS VARCHAR) AS patient, symptom,
           CASE symptom WHEN 'S1' THEN 'not a date' ELSE '2021-02-29' END AS date, 'date' AS bad_columns
    FROM diagnosis WHERE symptom IN ('S1', 'S2')""",
    "reject_counts_diagnosis": """
    SELECT count(*) AS n_rows, count(*) FILTER (symptom IN ('S1', 'S2')) AS n_rejected,
           count(*) FILTER (symptom IN ('S1', 'S2')) AS bad_date
    FROM diagnosis""",
}

EXTRA = {
    "contacts_by_worker": f"""
each_here AS (
    SELECT worker, date, hospital, weekday
    FROM (SELECT date, hospital, dayname(date) AS weekday FROM vaccination_event WHERE date {YEAR_1998})
    JOIN vaccination_shift USING (hospital, weekday))
""",
    "cumulative_fully_vaccinated_second": """
seconds AS (
    SELECT patient, date FROM vaccine_patient
    QUALIFY row_number() OVER (PARTITION BY patient ORDER BY date) = 2)
"""
}


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, statement in STATEMENTS.items():
        body, extra = statement if isinstance(statement, tuple) else (statement, EXTRA.get(name, ""))
        prefix = f"{BINDING},{extra}" if extra else BINDING
        result[name] = f"{prefix}{body}"
    return result
