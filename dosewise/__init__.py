"""Immunisation-programme analytics as lazy Spark DataFrame jobs."""

from dosewise.session import build_session
from dosewise.sources.contracts import CONTRACTS
from dosewise.sources.ingest import ingest, normalise_headers, rejected_rows
from dosewise.sources.tables import Tables, write_table

__all__ = [
    "CONTRACTS",
    "Tables",
    "build_session",
    "ingest",
    "normalise_headers",
    "rejected_rows",
    "write_table",
]
