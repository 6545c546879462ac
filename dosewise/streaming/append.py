"""Continuous load: new sheet files appended to a stored table as they arrive."""

from __future__ import annotations

import posixpath
import zlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dosewise.session import checkpoint_root
from dosewise.sources.contracts import Contract
from dosewise.sources.ingest import ingest
from dosewise.sources.tables import write_table


def normalised(path: str) -> str:
    """One spelling for a path: no doubled, trailing or ``./`` parts; the scheme stays."""
    scheme, mark, rest = path.rpartition("://")
    return f"{scheme}{mark}{posixpath.normpath(rest)}"


def append_stream(
    raw: DataFrame,
    contract: Contract,
    path: str,
    on_bad: str | None = None,
    checkpoint: str | None = None,
    date_format: str | None = None,
) -> StreamingQuery:
    """Start the append of a streaming sheet to the table at ``path``.

    Each micro-batch is an ordinary append that leaves out rows whose key the table has
    already (``write_table(keys=...)``), and is seen whole or not at all. It reads the parts
    of the key index that its own keys fall into, not the table. So the table holds plain
    files that batch loads and streams may write in any order, and no row depends on the
    progress log: a batch that is replayed, a log that was lost or a second log for the
    same table cost a second look at the files, and add nothing twice. Rows left out are
    kept beside the table (``refused_rows``).

    Progress is kept in ``checkpoint``, by default under the shared checkpoint folder by
    table and normalised path; a restart, also after lost executors, goes on where it
    stopped. The ingest holds no state, so the stream needs no watermark. The query
    handles what is there and ends; run it again, or on a schedule, for more.
    """
    target = normalised(path)
    if checkpoint is None:
        number = zlib.crc32(target.encode())
        checkpoint = f"{checkpoint_root(raw.sparkSession)}/append/{contract.table}-{number:08x}"

    def append(rows: DataFrame, _: int) -> None:
        write_table(rows, target, "append", keys=contract.key)

    return (
        ingest(raw, contract, on_bad, date_format)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
