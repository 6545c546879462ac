from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dosewise import CONTRACTS, Tables, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "dosewise-tests",
        master="local[4]",
        spark_sql_shuffle_partitions="4",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_ui_showConsoleProgress="false",
        spark_sql_maxPlanStringLength="1000000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _cell(value, kind):
    if value is None:
        return None
    if kind == "date" and isinstance(value, str):
        return date.fromisoformat(value)
    if kind == "timestamp" and isinstance(value, str):
        return datetime.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def tables(spark):
    """``tables(patient=[("a", "Ann", "1990-01-01", "F")], ...)``: contract-typed tables,
    empty where not given."""

    def build(**rows) -> Tables:
        frames = {}
        for name, contract in CONTRACTS.items():
            kinds = list(contract.columns.values())
            data = [tuple(_cell(v, k) for v, k in zip(row, kinds)) for row in rows.get(name, [])]
            frames[name] = spark.createDataFrame(data, contract.schema)
        return Tables(frames)

    return build


@pytest.fixture()
def conf(spark):
    """Set SQL configurations for one test."""
    before = {}

    def set_conf(**values):
        for key, value in values.items():
            key = key.replace("_", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df, *columns):
    """Sorted plain tuples, dates as text."""
    picked = df.select(*columns) if columns else df
    plain = [
        tuple(v.isoformat() if isinstance(v, (date, datetime)) else v for v in row) for row in picked.collect()
    ]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def final_plan(df) -> str:
    """Run the frame and return the plan adaptive execution ended with."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.rindex("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
