"""The twelve tables, and their raw sheets, derived from TPC-H-like order tables.

Hospitals are all suppliers, batches all parts, legs all line items, patients and staff
all customers, doses all orders, diagnoses all line items. Every order makes an event at
its place; those of December are held a day late, so that some doses have no event and
some events no dose, and every hospital also has an opening week nobody comes to. No source
row is left out, and all tables grow with their sources. Ids stay numbers.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewise.functions.dates import WEEKDAYS
from dosewise.sources.contracts import CONTRACTS
from dosewise.sources.tables import Tables

# Columns of the source tables. A given schema spares a job per table
# that would only open files to infer it.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _day(start: Date, offset: Column) -> Column:
    return F.date_add(F.lit(start), offset.cast("int"))


def _prefixed(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _type_id(number: Column) -> Column:
    return _prefixed("V0", number + 1)


class _Sample:
    """One method per table, named like it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.tables = Tables({name: getattr(self, name) for name in CONTRACTS})

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def vaccine_type(self) -> DataFrame:
        number = F.col("r_regionkey")
        return self.source("region").select(
            _type_id(number).alias("id"),
            F.col("r_name").alias("name"),
            (number % 3 + 1).alias("doses"),
            ((number + 1) * -10).alias("temp_min"),
            (8 - number).alias("temp_max"),
        )

    def manufacturer(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("id"),
            F.col("r_name").alias("origin"),
            _prefixed("tel-", F.col("n_nationkey")).alias("phone"),
            _type_id(F.col("r_regionkey")).alias("vaccine_type"),
        )

    def hospital(self) -> DataFrame:
        supplier = self.source("supplier")
        return supplier.join(self.source("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("name"),
            F.col("n_name").alias("address"),
            _prefixed("tel-", F.col("s_suppkey")).alias("phone"),
        )

    def n_hospitals(self) -> Column:
        return self.source("supplier").agg(F.count("*")).scalar()

    def batch(self) -> DataFrame:
        number = F.col("p_partkey")
        return self.source("part").select(
            number.alias("id"),
            (F.col("p_size") + 10).alias("num_of_vacc"),
            _type_id(number % 5).alias("vaccine_type"),
            _prefixed("NATION_", number % 25).alias("manufacturer"),
            _day(Date(1994, 1, 1), number % 365).alias("prod_date"),
            _day(Date(2002, 1, 1), number % 365).alias("exp_date"),
            (number % self.n_hospitals()).alias("hospital"),
        )

    def transport_log(self) -> DataFrame:
        shipped = F.col("l_shipdate")
        return self.source("lineitem").select(
            F.col("l_partkey").alias("batch"),
            ((F.col("l_suppkey") + 1) % self.n_hospitals()).alias("dep_hos"),
            F.col("l_suppkey").alias("arr_hos"),
            shipped.alias("dep_date"),
            (shipped + F.expr("interval 1 day")).alias("arr_date"),
        )

    def patient(self) -> DataFrame:
        number = F.col("c_custkey")
        return self.source("customer").select(
            number.alias("ssn"),
            F.col("c_name").alias("name"),
            _day(Date(1930, 1, 1), number * 7919 % 33238).alias("birthday"),
            F.when(number % 2 == 0, "F").otherwise("M").alias("gender"),
        )

    def _visit(self) -> tuple[Column, Column]:
        month = F.trunc("o_orderdate", "month")
        day = F.date_add(month, (F.col("o_orderkey") % 5).cast("int"))
        return day.alias("date"), (F.col("o_orderkey") % self.n_hospitals()).alias("hospital")

    def vaccine_patient(self) -> DataFrame:
        visits = self.source("orders").select(F.col("o_custkey").alias("patient"), *self._visit())
        return visits.groupBy("patient", "date").agg(F.min("hospital").alias("hospital"))

    def vaccination_event(self) -> DataFrame:
        day_number = F.datediff("date", F.lit(Date(1995, 1, 1)))
        n_batches = self.source("part").agg(F.count("*")).scalar()
        late = F.date_add("date", (F.month("date") == 12).cast("int")).alias("date")
        held = self.source("orders").select(*self._visit()).select(late, "hospital")
        # No order falls on the 7th to the 13th of a month.
        week = F.explode(F.sequence(F.lit(Date(1998, 12, 7)), F.lit(Date(1998, 12, 13)))).alias("date")
        opening = self.source("supplier").select(week, F.col("s_suppkey").alias("hospital"))
        events = held.union(opening).distinct()
        return events.withColumn("batch", (day_number * 10 + F.col("hospital")) % n_batches)

    def _grade(self) -> Column:
        return F.floor(F.sqrt("p_size")).cast("int")

    def diagnosis(self) -> DataFrame:
        reported = self.source("lineitem").select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("date"))
        orders = self.source("orders").select("o_orderkey", F.col("o_custkey").alias("patient"))
        part = self.source("part").select("p_partkey", _prefixed("S", self._grade()).alias("symptom"))
        return (
            reported.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select("patient", "symptom", "date")
            .distinct()
        )

    def symptoms(self) -> DataFrame:
        # One symptom beyond the highest grade stays without a diagnosis.
        grades = self.source("part").select(F.explode(F.array(self._grade(), self._grade() + 1)).alias("grade"))
        return grades.distinct().select(
            _prefixed("S", F.col("grade")).alias("name"), (F.col("grade") >= 6).alias("critical")
        )

    def staff(self) -> DataFrame:
        number = F.col("c_custkey")
        role = F.when(number % 3 == 0, "doctor").when(number % 3 == 1, "nurse").otherwise("other")
        return self.source("customer").select(
            number.alias("ssn"),
            F.col("c_name").alias("name"),
            _day(Date(1960, 1, 1), number % 14000).alias("birthday"),
            _prefixed("tel-", number).alias("phone"),
            role.alias("role"),
            (F.col("c_acctbal") > 0).alias("vacc_status"),
            (number % self.n_hospitals()).alias("hospital"),
        )

    def vaccination_shift(self) -> DataFrame:
        names = F.array(*[F.lit(name) for name in WEEKDAYS])
        days = F.explode(F.array(F.col("ssn") % 7, (F.col("ssn") + 3) % 7)).alias("day")
        shifts = self.tables["staff"].select("hospital", days, F.col("ssn").alias("worker"))
        weekday = F.element_at(names, (F.col("day") + 1).cast("int"))
        return shifts.select("hospital", weekday.alias("weekday"), "worker")


def sample_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _Sample(spark, sf_dir).tables


def as_sheet(df: DataFrame, table: str, date_format: str | None = None) -> DataFrame:
    """A clean table the way its spreadsheet delivers it: sheet headers, every cell text,
    flags as 0/1, stray blanks around headers where the sheet has them, dates in ISO or in
    ``date_format``."""
    contract = CONTRACTS[table]
    headers = {column: header for header, column in contract.headers.items()}
    cells = []
    for column, kind in contract.columns.items():
        cell = F.col(column).cast("int") if kind == "bool" else F.col(column)
        if date_format is not None and kind == "date":
            cell = F.date_format(cell, date_format)
        header = headers.get(column, column)
        cells.append(cell.cast("string").alias(f" {header} " if contract.strip_headers else header))
    return df.select(*cells)


def diagnosis_sheet(t: Tables) -> DataFrame:
    """The diagnosis sheet with both kinds of bad date: text, and a day that never was."""
    sheet = as_sheet(t["diagnosis"], "diagnosis")
    damaged = (
        F.when(F.col("symptom") == "S1", "not a date")
        .when(F.col("symptom") == "S2", "2021-02-29")
        .otherwise(F.col("date"))
    )
    return sheet.withColumn("date", damaged)
