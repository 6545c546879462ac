"""Session defaults. Jobs never depend on them for right results."""

from __future__ import annotations

import os
import re

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Adaptive execution does four things the jobs count on at scale, all after it has
# seen shuffled sizes: it broadcasts a side that turned out small, joins by hash
# instead of sorting both sides if every partition of one side fits the local limit,
# splits a hot join key over several tasks, and merges small partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}
CLUSTER = {
    "spark.sql.files.maxPartitionBytes": "512m",
    # Lost executors take shuffle files along; allow for more than the usual retries.
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "10",
}
LOCAL = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}

HASH_JOIN_LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}
# A hashed partition cannot spill, and its size is known as shuffled, compressed bytes: as
# rows in a hash table they take several times that. A task has its share of 60 % of the
# heap; a twentieth of the heap per core leaves that room.
HASH_JOIN_SHARE = 20


def _bytes(size: str) -> int:
    text = size.strip().lower().removesuffix("b")
    unit = text[-1:] if text[-1:] in UNITS and not text[-1:].isdigit() else ""
    return int(text.removesuffix(unit)) << UNITS[unit]


def hash_join_limit(conf: SparkConf | None = None) -> int:
    """Bytes up to which a shuffled partition is joined by hash, from the memory of an
    executor (a local session: of the driver) and the number of tasks that share it."""
    conf = conf or SparkConf()
    master = conf.get("spark.master", "local[1]")
    if master.startswith("local[") or master == "local":
        memory, cores = conf.get("spark.driver.memory", "1g"), re.sub(r"\D", "", master.split(",")[0]) or str(os.cpu_count())
    else:
        memory, cores = conf.get("spark.executor.memory", "1g"), conf.get("spark.executor.cores", "1")
    return _bytes(memory) // (HASH_JOIN_SHARE * max(int(cores), 1))


def shuffle_partitions(input_bytes: int, advisory: int = 128 << 20) -> int:
    """Partitions for a shuffle of all of ``input_bytes``, each of the advisory size.

    Adaptive execution can merge partitions at run time but not add any, so a cluster
    starts with enough: 100 TB need 800,000.
    """
    return max(200, -(-input_bytes // advisory))


def build_session(
    app_name: str = "dosewise", master: str | None = None, input_bytes: int = 4 << 40, **overrides: str
) -> SparkSession:
    """Start (or reuse) a session; anything already configured on the cluster wins.

    ``input_bytes`` is about how much the largest job reads; a cluster's number of shuffle
    partitions follows from it. ``overrides`` are passed as ``spark_sql_shuffle_partitions="8"`` (underscores
    for dots).
    """
    given = {key.replace("_", "."): value for key, value in overrides.items()}
    configured = SparkConf()
    target = master or configured.get("spark.master", "")
    partitions = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))}
    defaults = {**DEFAULTS, **(LOCAL if target.startswith("local") else {**CLUSTER, **partitions})}
    known = SparkConf().setMaster(target or "local[1]")
    for key, value in given.items():
        known.set(key, value)
    defaults[HASH_JOIN_LIMIT] = str(hash_join_limit(known))
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**defaults, **given}.items():
        if key in given or not configured.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Let a session started elsewhere join by hash where partitions are small.

    Spark ships with this off, and a limit already set stays. Otherwise the caller's
    session gets ``hash_join_limit`` of its own memory, for all its queries; larger
    partitions are joined by sorting as before.
    """
    if spark.conf.get(HASH_JOIN_LIMIT) in ("0", "0b"):
        spark.conf.set(HASH_JOIN_LIMIT, str(hash_join_limit(spark.sparkContext.getConf())))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; there is no other."""
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return configured.rstrip("/")
