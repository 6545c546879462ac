"""Every registered query against its DuckDB statement, values and column types."""

from __future__ import annotations

import re

import __spark_entry__ as registry
import duckdb
import pytest
from conftest import rows

from dosewise import CONTRACTS
from dosewise.sources.sample import sample_tables

SF_DIR = "/root/testdata/sf0.001"
SOURCES = "region nation customer supplier part orders lineitem".split()
ORACLE = registry.oracle_sql()
DUCK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(registry.JOBS) <= set(registry.queries()) and set(registry.JOBS) == set(registry.oracles.STATEMENTS)


@pytest.mark.parametrize("name", sorted(registry.JOBS))
def test_query_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    found = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in found.description}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    order = sorted(types)
    expected = found.fetchall()
    names = list(types)
    picked = [tuple(row[names.index(c)] for c in order) for row in expected]
    plain = sorted(
        (tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in r) for r in picked),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert rows(df.select(*[f"`{c}`" for c in order])) == plain


def test_entry_is_lazy_and_has_rows(spark):
    df = registry.entry(spark)
    assert df.columns == ["batch", "last_location", "current_location"]
    assert df.count() >= 200


@pytest.mark.parametrize("table", sorted(CONTRACTS))
def test_sources_are_read_whole(spark, table):
    """Every filter in the plan of a bound table is a null test for a join."""
    df = sample_tables(spark, SF_DIR)[table]
    plan = re.sub(r"#\d+L?", "#n", df._jdf.queryExecution().optimizedPlan().toString())
    assert not re.search(r"Limit|Sample", plan)
    filters = re.findall(r"Filter (.*)", plan)
    parts = {p for f in filters for p in re.split(r" AND ", f.removeprefix("(").removesuffix(")") if " AND " in f else f)}
    own = {p.strip("()") for p in parts if "isnotnull(" not in p}
    assert not own, own


def test_tables_grow_with_their_sources(spark):
    small, large = sample_tables(spark, SF_DIR), sample_tables(spark, "/root/testdata/sf0.01")
    fixed = {"vaccine_type", "manufacturer", "symptoms"}  # of regions, nations and sizes
    for name in set(CONTRACTS) - fixed:
        assert large[name].count() >= 5 * small[name].count(), name
