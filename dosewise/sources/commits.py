"""Appends by key that are seen whole or not at all, and say what they left out.

A table is a folder of data files that any reader can list. Beside them, in folders that
Spark passes over, are an index of the keys that are stored, the rows that appends left
out, and one small record for each append:

* ``_keys/bucket=n`` has two 64-bit hashes of each stored key. An append reads the buckets that
  its own keys fall into, and of the data files only those that came by other ways and
  are not indexed yet; it indexes them too. The folder may be deleted: the next append
  makes it anew from the data, with one file a bucket.
* An append writes all it has to a folder under ``_staged`` first. Then it makes the record
  of the next number in ``_commits``, which can be made only once: that is the commit. Last it
  moves its files into place. Whoever finds a record whose files are still staged moves
  them, so an append that stopped in between is finished by the next one.
* An append that finds its number taken has been overtaken: it looks at the keys that
  came in the meantime and tries again.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS, REFUSED, STAGED, COMMITS = "_keys", "_refused", "_staged", "_commits"
OWN = "keyed-"  # begins the names of data files that came with their keys
BUCKETS = 256
ATTEMPTS = 50
HASHED = "one bigint, other bigint"


class Folder:
    """A folder of a file system that Spark reads, by Hadoop's interface to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm
        self.fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path(posixpath.join(self.root, *parts))

    def at(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def files(self, *parts: str, hidden: bool = False) -> Iterator[str]:
        """Files below a folder, as paths from it; hidden ones and folders only if asked for."""
        path = self._path(*parts)
        for status in self.fs.listStatus(path) if self.fs.exists(path) else []:
            name = status.getPath().getName()
            if name[0] in "._" and not hidden:
                continue
            if status.isDirectory():
                yield from (posixpath.join(name, f) for f in self.files(*parts, name, hidden=hidden))
            else:
                yield name

    def move(self, source: str, target: str) -> None:
        """Move a file, unless somebody else has done it."""
        goal = self._path(target)
        self.fs.mkdirs(goal.getParent())
        try:
            moved = self.fs.rename(self._path(source), goal)
        except Exception:  # gone while it was moved
            moved = False
        if not moved and not self.fs.exists(goal):
            raise OSError(f"{source} could not be moved to {target}")

    def create(self, text: str, *parts: str) -> bool:
        """Make a file that nobody has made yet; False if somebody has."""
        path = self._path(*parts)
        self.fs.mkdirs(path.getParent())
        if self.fs.exists(path):
            return False
        # Written in full under a name of its own; the rename refuses a name that is taken.
        draft = self._path(*parts[:-1], f".{parts[-1]}-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, path, options)
            return True
        except Exception as error:
            self.fs.delete(draft, False)
            if not self.fs.exists(path):
                raise OSError(f"{path.toString()} could not be made") from error
            return False

    def text(self, *parts: str) -> str:
        path = self._path(*parts)
        stream = self.fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, *parts: str) -> None:
        self.fs.delete(self._path(*parts), True)


@dataclass(frozen=True)
class Appended:
    """What an append did. ``refused`` are the rows whose key was stored before, as they were
    given; ``version`` is the number of its record, ``None`` if there was nothing to write."""

    version: int | None
    n_added: int
    n_refused: int
    refused: DataFrame


def _hashes(keys: Sequence[str]) -> list[Column]:
    # Missing cells are hashed as such: they compare as equal, and as nothing else.
    marked = [x for k in keys for x in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return [F.xxhash64(F.lit(seed), *marked).alias(name) for seed, name in ((1, "one"), (2, "other"))]


def _bucket(n: int) -> Column:
    return F.pmod(F.col("one"), F.lit(n)).cast("int")


def _finish(folder: Folder) -> int:
    """Move what the last committed append has left staged; its number. Appends before it are
    finished: this one looked after them before it made its record."""
    last = max((int(n) for n in folder.names(COMMITS) if n.isdigit()), default=0)
    if last and folder.names(STAGED):
        record = json.loads(folder.text(COMMITS, str(last)))
        staged = record["staged"]
        if folder.fs.exists(folder._path(STAGED, staged)):
            for source, target in record["moves"]:
                if folder.fs.exists(folder._path(STAGED, staged, source)):
                    folder.move(posixpath.join(STAGED, staged, source), target)
            folder.delete(STAGED, staged)
    return last


def recover(spark: SparkSession, path: str) -> int:
    """Finish appends that stopped after their commit; the number of the last one."""
    return _finish(Folder(spark, path))


def _indexed(folder: Folder, files: list[str]) -> set[str]:
    """Which data files the index knows: those of appends by key, and those it has taken in."""
    if not folder.names(KEYS):
        return set()
    taken = {name for part in folder.names(KEYS, "files") for name in folder.text(KEYS, "files", part).splitlines()}
    return {f for f in files if posixpath.basename(f).startswith(OWN) or f in taken}


def _known(folder: Folder, buckets: list[int]) -> DataFrame:
    """The hashes of stored keys in some buckets."""
    paths = [folder.at(KEYS, f"bucket={b}") for b in buckets if folder.fs.exists(folder._path(KEYS, f"bucket={b}"))]
    spark = folder.spark
    return spark.read.schema(HASHED).parquet(*paths) if paths else spark.createDataFrame([], HASHED)


def _unindexed(folder: Folder, df: DataFrame, fmt: str, keys: Sequence[str]) -> tuple[list[str], DataFrame | None]:
    """Data files that came by other ways, and the hashes of their keys."""
    files = list(folder.files())
    known = _indexed(folder, files)
    files = [f for f in files if f not in known]
    if not files:
        return [], None
    read = folder.spark.read.format(fmt).schema(df.schema).option("basePath", folder.root).load([folder.at(f) for f in files])
    return files, read.select(*_hashes(keys)).distinct()


def append_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> Appended:
    """Append the rows of ``df`` whose key is not stored, and say which are left out.

    Keys that repeat within ``df`` are all added, for the validator to report. Two keys are
    the same if their 128-bit hashes are. ``df`` is computed once for each attempt. On a file
    system without an exclusive rename (some object stores) two appends at once are not
    kept apart; one at a time always works.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    for _ in range(ATTEMPTS):
        last = _finish(folder)
        own = uuid.uuid4().hex
        staged = posixpath.join(STAGED, own)
        try:
            record = _stage(folder, staged, df, keys, fmt, partition_by, buckets)
            added, refused = record.pop("added"), record.pop("refused")
            if not record["moves"]:
                folder.delete(staged)
                return Appended(None, 0, 0, df.limit(0))
            if folder.create(json.dumps({"staged": own, **record}), COMMITS, str(last + 1)):
                _finish(folder)
                left_out = _read_refused(folder, own, df) if refused else df.limit(0)
                return Appended(last + 1, added, refused, left_out)
        except BaseException:
            if not _is_committed(folder, last + 1, own):
                folder.delete(staged)
            raise
        folder.delete(staged)
    raise RuntimeError(f"{ATTEMPTS} other appends to {path} came first")


def _is_committed(folder: Folder, version: int, staged: str) -> bool:
    return str(version) in folder.names(COMMITS) and json.loads(folder.text(COMMITS, str(version)))["staged"] == staged


def _stage(
    folder: Folder, staged: str, df: DataFrame, keys: Sequence[str], fmt: str, partition_by: Sequence[str], buckets: int
) -> dict:
    """Write new rows, rows left out and the new keys' hashes; what to move where."""
    spark = folder.spark
    files, fresh = _unindexed(folder, df, fmt, keys)
    # The rows are written once with their hashes, then parted: they are not computed twice.
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *_hashes(keys))
    given.withColumn("bucket", _bucket(buckets)).write.parquet(folder.at(staged, "given"))
    rows = spark.read.parquet(folder.at(staged, "given"))
    used = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
    known = _known(folder, used)
    known = (known if fresh is None else known.union(fresh)).distinct()
    known = known.select(F.col("one").alias("k1"), F.col("other").alias("k2"), F.lit(True).alias("known"))
    met = rows.join(known, (F.col("one") == F.col("k1")) & (F.col("other") == F.col("k2")), "left")
    parted = met.select("row", "one", "other", "bucket", F.coalesce("known", F.lit(False)).alias("refused"))
    parted.write.partitionBy("refused").parquet(folder.at(staged, "parted"))
    parted = spark.read.schema(f"row {df.schema.simpleString()}, {HASHED}, bucket int, refused boolean").parquet(folder.at(staged, "parted"))
    counts = {r.refused: r.n for r in parted.groupBy("refused").agg(F.count("*").alias("n")).collect()}
    moves: list[tuple[str, str]] = []
    own = posixpath.basename(staged)
    if counts.get(False):
        writer = parted.where("not refused").select("row.*").write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(folder.at(staged, "rows"))
        for f in folder.files(staged, "rows"):
            below, name = posixpath.split(f)
            moves.append((posixpath.join("rows", f), posixpath.join(below, OWN + name)))
    if counts.get(True):
        parted.where("refused").select("row.*").write.parquet(folder.at(staged, "refused"))
        moves += [(posixpath.join("refused", f), posixpath.join(REFUSED, own, f)) for f in folder.files(staged, "refused")]
    hashed = parted.where("not refused").select("one", "other", "bucket").distinct()
    if fresh is not None:
        hashed = hashed.union(fresh.withColumn("bucket", _bucket(buckets))).distinct()
    if counts.get(False) or files:
        # One task a bucket at most, so an append adds one file to each bucket that it touches.
        hashed.repartition("bucket").write.partitionBy("bucket").parquet(folder.at(staged, "keys"))
        moves += [(posixpath.join("keys", f), posixpath.join(KEYS, f)) for f in folder.files(staged, "keys")]
    if files:
        folder.create("\n".join(files), staged, "files")
        moves.append(("files", posixpath.join(KEYS, "files", own)))
    # What is read last is moved last: files that are in place are always known by then.
    return {"moves": sorted(moves, key=lambda m: not m[1].startswith(KEYS)), "added": counts.get(False, 0), "refused": counts.get(True, 0)}


def _read_refused(folder: Folder, own: str, df: DataFrame) -> DataFrame:
    return folder.spark.read.schema(df.schema).parquet(folder.at(REFUSED, own))


def refused_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that appends to a table have left out; ``None`` if there are none."""
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(posixpath.join(path, REFUSED))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
