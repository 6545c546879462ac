"""Cell parsers: a column of any source type to a contract type, NULL where it does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

def _timestamp(cell: Column, source: DataType, date_format: str | None) -> Column:
    if isinstance(source, (DateType, TimestampType, TimestampNTZType)):
        return cell.cast("timestamp_ntz")
    if not isinstance(source, StringType):
        return F.lit(None).cast("timestamp_ntz")
    # A spreadsheet export writes yyyy-MM-dd, with or without a time. A plain cast would
    # also take '2021' and '2021-5' for dates.
    text = F.trim(cell)
    if date_format is not None:
        return F.try_to_timestamp(text, F.lit(date_format)).cast("timestamp_ntz")
    whole = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(whole, text.try_cast("timestamp_ntz"))


def _date(cell: Column, source: DataType, date_format: str | None) -> Column:
    if isinstance(source, DateType):
        return cell
    return _timestamp(cell, source, date_format).cast("date")


def _bool(cell: Column, source: DataType) -> Column:
    if isinstance(source, BooleanType):
        return cell
    if isinstance(source, StringType):
        # '1' casts to a boolean, '1.0' only by way of a number.
        return F.coalesce(cell.try_cast("boolean"), cell.try_cast("double") != 0)
    return cell.try_cast("double") != 0


def _int(cell: Column, source: DataType) -> Column:
    if isinstance(source, IntegerType):
        return cell
    number = cell.try_cast("double")
    # A spreadsheet hands whole numbers over as '10.0'; 10.5 is not a whole number.
    return F.when(number == F.floor(number), number.try_cast("int"))


def _text(cell: Column, source: DataType) -> Column:
    return cell if isinstance(source, StringType) else cell.cast("string")


_PARSERS = {
    "text": _text,
    "char1": _text,
    "int": _int,
    "date": _date,
    "timestamp": _timestamp,
    "bool": _bool,
}


def parse_cell(cell: Column, source: DataType, kind: str, date_format: str | None = None) -> Column:
    if kind in ("date", "timestamp"):
        return _PARSERS[kind](cell, source, date_format)
    return _PARSERS[kind](cell, source)
