"""Tables written to the shared folder, and columns handled by every operator alike."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A local session without it (tests) gets a temporary
    folder and keeps it; on a cluster a missing setting is an error."""
    folder = spark.conf.get(CHECKPOINT_DIR, "")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="llm-tables-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The folder of all tables that this application has written with ``stored``."""
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    Later steps read files that outlive executors, so nothing upstream runs twice. Results
    read such tables, so they stay until ``drop_run`` or whoever owns the folder deletes them.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        own = run_folder(spark).rsplit("/", 1)[1]
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if f"/{own}/" in path:
                _delete(spark, path)


def drop_run(spark: SparkSession) -> None:
    """Delete every table that this application has stored: once its results are written."""
    _delete(spark, run_folder(spark))


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, to be handed to Python in Arrow batches of a few MB.

    Spark's own limit of 64 MB is held several times over, by the JVM and by each Python
    worker beside it, and texts are long. A smaller limit of the session stays.
    """
    conf = df.sparkSession.conf
    limit = conf.get(BATCH_BYTES).removesuffix("b")
    if not limit.isdigit() or int(limit) > MOST_BATCH_BYTES:
        conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
    return df


def same(left: Column, right: Column) -> Column:
    """Equality for join keys in which null equals null."""
    return left.eqNullSafe(right)


def document_key(df: DataFrame, text: str = "text") -> list[Column]:
    """What tells one document row from another: its id and two hashes of its text.

    Rows equal in both are copies of one document; every operator decides alike for them.
    """
    return [F.col("doc_id"), F.xxhash64(F.col(text)).alias("text_h1"), F.crc32(F.col(text).cast("binary")).alias("text_h2")]
