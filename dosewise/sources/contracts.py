"""What each of the twelve tables must look like, and how its raw sheet maps to it.

A contract is plain data: the ingest reads the header map and the column types,
the validator reads the keys, references and checks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TYPES: dict[str, DataType] = {
    "text": StringType(),
    "char1": StringType(),
    "int": IntegerType(),
    "date": DateType(),
    "timestamp": TimestampNTZType(),
    "bool": BooleanType(),
}


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def label(self) -> str:
        return f"{', '.join(self.columns)} -> {self.parent}"


@dataclass(frozen=True)
class Contract:
    table: str
    sheet: str
    columns: dict[str, str]
    key: tuple[str, ...]
    headers: dict[str, str]
    references: tuple[Reference, ...] = ()
    checks: tuple[str, ...] = ()
    strip_headers: bool = False
    on_bad: str = "fail"

    @property
    def schema(self) -> StructType:
        """Stored schema. Nullable, because Spark does not enforce NOT NULL on files:
        the validator counts missing values instead."""
        return StructType([StructField(name, TYPES[kind]) for name, kind in self.columns.items()])

    @property
    def row_checks(self) -> tuple[str, ...]:
        """Declared checks plus the one-character rule that a fixed-width type implies."""
        implied = tuple(
            f"length({name}) = 1" for name, kind in self.columns.items() if kind == "char1"
        )
        return self.checks + implied


def _refs(*specs: tuple[str, str, str]) -> tuple[Reference, ...]:
    return tuple(
        Reference(tuple(child.split()), parent, tuple(columns.split()))
        for child, parent, columns in specs
    )


# Table, column and sheet names, header maps, keys, references and
# checks as the source system declares them.
CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        Contract(
            table="vaccine_type",
            sheet="VaccineType",
            columns={"id": "text", "name": "text", "doses": "int", "temp_min": "int", "temp_max": "int"},
            key=("id",),
            headers={"tempMin": "temp_min", "tempMax": "temp_max"},
            checks=("doses > 0", "temp_min < temp_max"),
        ),
        Contract(
            table="manufacturer",
            sheet="Manufacturer",
            columns={"id": "text", "origin": "text", "phone": "text", "vaccine_type": "text"},
            key=("id",),
            headers={"country": "origin", "vaccine": "vaccine_type"},
            references=_refs(("vaccine_type", "vaccine_type", "id")),
        ),
        Contract(
            table="hospital",
            sheet="VaccinationStations",
            columns={"name": "text", "address": "text", "phone": "text"},
            key=("name",),
            headers={},
        ),
        Contract(
            table="batch",
            sheet="VaccineBatch",
            columns={
                "id": "text",
                "num_of_vacc": "int",
                "vaccine_type": "text",
                "manufacturer": "text",
                "prod_date": "date",
                "exp_date": "date",
                "hospital": "text",
            },
            key=("id",),
            headers={
                "batchID": "id",
                "amount": "num_of_vacc",
                "type": "vaccine_type",
                "manufDate": "prod_date",
                "expiration": "exp_date",
                "location": "hospital",
            },
            references=_refs(
                ("vaccine_type", "vaccine_type", "id"),
                ("hospital", "hospital", "name"),
                ("manufacturer", "manufacturer", "id"),
            ),
            checks=("num_of_vacc > 0", "prod_date < exp_date"),
        ),
        Contract(
            table="transport_log",
            sheet="Transportation log",
            columns={
                "batch": "text",
                "dep_hos": "text",
                "arr_hos": "text",
                "dep_date": "timestamp",
                "arr_date": "timestamp",
            },
            key=("batch", "dep_hos", "arr_hos", "dep_date", "arr_date"),
            headers={
                "batchID": "batch",
                "departure ": "dep_hos",
                "arrival": "arr_hos",
                "dateArr": "arr_date",
                "dateDep": "dep_date",
            },
            references=_refs(
                ("batch", "batch", "id"),
                ("dep_hos", "hospital", "name"),
                ("arr_hos", "hospital", "name"),
            ),
        ),
        Contract(
            table="staff",
            sheet="StaffMembers",
            columns={
                "ssn": "text",
                "name": "text",
                "birthday": "date",
                "phone": "text",
                "role": "text",
                "vacc_status": "bool",
                "hospital": "text",
            },
            key=("ssn",),
            headers={
                "social security number": "ssn",
                "date of birth": "birthday",
                "vaccination status": "vacc_status",
            },
            references=_refs(("hospital", "hospital", "name")),
        ),
        Contract(
            table="vaccination_shift",
            sheet="Shifts",
            columns={"hospital": "text", "weekday": "text", "worker": "text"},
            key=("worker", "weekday", "hospital"),
            headers={"station": "hospital"},
            references=_refs(("hospital", "hospital", "name"), ("worker", "staff", "ssn")),
        ),
        Contract(
            table="vaccination_event",
            sheet="Vaccinations",
            columns={"date": "date", "hospital": "text", "batch": "text"},
            key=("date", "hospital"),
            headers={"batchID": "batch", "location": "hospital"},
            references=_refs(("hospital", "hospital", "name"), ("batch", "batch", "id")),
            strip_headers=True,
        ),
        Contract(
            table="patient",
            sheet="Patients",
            columns={"ssn": "text", "name": "text", "birthday": "date", "gender": "char1"},
            key=("ssn",),
            headers={"ssNo": "ssn", "date of birth": "birthday"},
        ),
        Contract(
            table="vaccine_patient",
            sheet="VaccinePatients",
            columns={"patient": "text", "date": "date", "hospital": "text"},
            key=("patient", "date"),
            headers={"patientSsNo": "patient", "location": "hospital"},
            references=_refs(
                ("date hospital", "vaccination_event", "date hospital"),
                ("patient", "patient", "ssn"),
                ("hospital", "hospital", "name"),
            ),
            strip_headers=True,
        ),
        Contract(
            table="symptoms",
            sheet="Symptoms",
            columns={"name": "text", "critical": "bool"},
            key=("name",),
            headers={"criticality": "critical"},
        ),
        Contract(
            table="diagnosis",
            sheet="Diagnosis",
            columns={"patient": "text", "symptom": "text", "date": "date"},
            key=("patient", "symptom", "date"),
            headers={},
            references=_refs(("patient", "patient", "ssn"), ("symptom", "symptoms", "name")),
            on_bad="drop",
        ),
    )
}
