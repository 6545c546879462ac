"""The twelve tables as one read-only mapping, their readers and their sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dosewise.sources.commits import Appended, append_new
from dosewise.sources.contracts import CONTRACTS, Contract
from dosewise.sources.ingest import ingest

WRITE_MODES = ("append", "overwrite")


def read_source(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """One sheet or table from any Spark source (csv, json, parquet, orc, jdbc, ...).

    CSV keeps its header line and reads every cell as text: types come from the
    contract, never from a second inference pass over the data. JSON has no header, so
    give large files a ``schema``, or Spark reads them once more to find their fields.
    """
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "false", **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> Appended | None:
    """Append rows to a stored table or replace it.

    With ``keys``, an append leaves out rows whose key is stored already, as a table with
    that key would, and returns what it added and which rows it left out (``append_new``):
    writing the same rows again adds nothing and says so. Missing key cells compare as
    equal. Keys that repeat within ``df`` are for the validator to report.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    if keys and mode == "append":
        return append_new(df, path, keys, fmt, partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return None


class Tables(Mapping[str, DataFrame]):
    """Table name to lazy DataFrame. Nothing is read until a job runs.

    A table may be given as a function that makes it; it is called on first use, so a
    job over two tables does not resolve the other ten.
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        unknown = sorted(set(frames) - set(CONTRACTS))
        if unknown:
            raise ValueError(f"unknown tables {unknown}")
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if callable(frame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    @classmethod
    def stored(cls, spark: SparkSession, root: str) -> Tables:
        """Clean tables kept as ``root/<table>`` parquet, read with the contract schema."""

        def reader(contract: Contract) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(contract.schema).parquet(f"{root}/{contract.table}")

        return cls({name: reader(contract) for name, contract in CONTRACTS.items()})

    @classmethod
    def from_sheets(cls, sheets: Mapping[str, DataFrame]) -> Tables:
        """Raw sheets, keyed by sheet name, through the ingest."""
        by_sheet = {c.sheet: c for c in CONTRACTS.values()}
        return cls({by_sheet[name].table: ingest(raw, by_sheet[name]) for name, raw in sheets.items()})

    def replaced(self, **frames: DataFrame) -> Tables:
        return Tables({**self._frames, **frames})

    def save(self, root: str, mode: str = "append") -> dict[str, Appended]:
        """Write every table, parents before the tables that refer to them. An append
        leaves out rows whose key is stored already, so a second load adds nothing; it
        returns by table what was added and which rows were left out."""
        done = {}
        for name, contract in CONTRACTS.items():
            if name in self:
                done[name] = write_table(self[name], f"{root}/{name}", mode, keys=contract.key)
        return {name: appended for name, appended in done.items() if appended is not None}

    def create_views(self) -> None:
        """Session views under the table names, for ad-hoc ``spark.sql``."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)
