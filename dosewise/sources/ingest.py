"""Raw sheet to contract table: header normalisation, typed parsing, bad-row policy.

Every step is a projection or a filter, so the same functions serve batch and
streaming frames and nothing shuffles.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.functions.parsing import parse_cell
from dosewise.sources.contracts import Contract

TEXT_KINDS = ("text", "char1")
POLICIES = ("fail", "drop")


def normalise_headers(df: DataFrame, renames: dict[str, str], strip: bool = False) -> DataFrame:
    """Strip blanks (optional), rename by exact header, lower-case what is left.

    Header matching is case-sensitive, unlike Spark's own rename.
    """
    headers = [name.strip() if strip else name for name in df.columns]
    return df.toDF(*[renames.get(name, name).lower() for name in headers])


def _normalised(raw: DataFrame, contract: Contract) -> DataFrame:
    df = normalise_headers(raw, contract.headers, contract.strip_headers)
    missing = [name for name in contract.columns if name not in df.columns]
    if missing:
        raise ValueError(f"sheet {contract.sheet!r} lacks columns {missing}; found {df.columns}")
    return df


def _parsed(df: DataFrame, contract: Contract, date_format: str | None) -> dict[str, Column]:
    return {
        name: parse_cell(F.col(f"`{name}`"), df.schema[name].dataType, kind, date_format)
        for name, kind in contract.columns.items()
    }


def _fits(parsed: dict[str, Column], contract: Contract) -> Column:
    typed = [parsed[name].isNotNull() for name, kind in contract.columns.items() if kind not in TEXT_KINDS]
    return reduce(and_, typed, F.lit(True))


def ingest(
    raw: DataFrame, contract: Contract, on_bad: str | None = None, date_format: str | None = None
) -> DataFrame:
    """The rows of ``raw`` as a contract table.

    Text cells hold dates in ISO form, or in ``date_format`` (a Spark datetime pattern).

    ``on_bad='fail'`` stops the job on a cell that does not parse (a missing cell
    passes on to the validator); ``'drop'`` leaves out rows with such a cell, or
    with none; ``reject_counts`` says how many. The contract names the default.
    """
    policy = on_bad or contract.on_bad
    if policy not in POLICIES:
        raise ValueError(f"on_bad must be one of {POLICIES}, not {policy!r}")
    df = _normalised(raw, contract)
    parsed = _parsed(df, contract, date_format)
    if policy == "drop":
        return df.where(_fits(parsed, contract)).select(
            *[value.alias(name) for name, value in parsed.items()]
        )
    strict = []
    for name, kind in contract.columns.items():
        value = parsed[name]
        if kind not in TEXT_KINDS:
            cell = F.col(f"`{name}`")
            message = F.concat(
                F.lit(f"{contract.table}.{name}: cannot read as {kind}: "), cell.cast("string")
            )
            refused = F.raise_error(message).cast(contract.schema[name].dataType)
            value = F.coalesce(value, F.when(cell.isNotNull(), refused))
        strict.append(value.alias(name))
    return df.select(*strict)


def reject_counts(raw: DataFrame, contract: Contract, date_format: str | None = None) -> DataFrame:
    """One row: ``n_rows`` of the sheet, ``n_rejected`` that ``on_bad='drop'`` leaves out, and
    for each typed column ``bad_<column>``. One scan."""
    df = _normalised(raw, contract)
    parsed = _parsed(df, contract, date_format)
    typed = [name for name, kind in contract.columns.items() if kind not in TEXT_KINDS]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~_fits(parsed, contract)).alias("n_rejected"),
        *[F.count_if(parsed[name].isNull()).alias(f"bad_{name}") for name in typed],
    )


def rejected_rows(raw: DataFrame, contract: Contract, date_format: str | None = None) -> DataFrame:
    """The rows ``ingest(..., on_bad='drop')`` leaves out, cells as they came.

    ``bad_columns`` names the cells at fault. Together the two results hold every
    input row exactly once.
    """
    df = _normalised(raw, contract)
    parsed = _parsed(df, contract, date_format)
    faults = F.array_compact(
        F.array(
            *[
                F.when(parsed[name].isNull(), F.lit(name))
                for name, kind in contract.columns.items()
                if kind not in TEXT_KINDS
            ]
        )
    )
    return df.where(~_fits(parsed, contract)).select("*", faults.alias("bad_columns"))
