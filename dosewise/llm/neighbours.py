"""Approximate nearest neighbours by inner product, from shifted space-filling curves.

Every vector is projected to a few dimensions, by another rotation and shift for each
curve, and lies on that Hilbert curve at a key. Spark sorts each curve by key in ranges. A
query meets the vectors whose places on a curve are within some rows of its own; the
curves' finds are merged and ranked by exact inner products. How many rows is measured: for
a bounded sample of the queries the true neighbours are found by a scan, and the reach is
the least with which ``TARGET`` of them stand near enough on one curve at least. Where vectors
have clusters that is a few hundred rows, whatever the size of the table; without any
structure it is a share of the table, and the curves cost more than a scan.

Inner products become distances by one more dimension that evens out the norms of the
vectors; queries have zero there. Equal vectors are one entry of the index, so a vector
with a third of all rows is as cheap as any, and ties among copies come out by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.tables import in_small_batches, stored

CURVES = 16
AXES, BITS = 8, 6
TARGET = 0.95  # share of the true neighbours within reach, by the sample
SAMPLE = 64  # queries whose true neighbours are found
LEAST_BLOCK, BLOCK = 64, 2048  # rows that are compared together: about a reach, within these
CHUNK = 16384  # queries that meet a block in one task
SPREAD = 3.0  # standard deviations of a projected vector that a curve covers
SEED = 7


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Keys along the Hilbert curve of the rows of ``points``, whole numbers below 2**bits.

    Per level from the top, the part of the cube that a point is in is turned and mirrored
    so that the curve enters it like the whole; the Gray code of the parts is the key.
    """
    x = points.astype(np.int64).T.copy()
    n_axes = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(n_axes):
            upper = (x[axis] >> level) & 1 == 1
            swapped = np.where(upper, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swapped)
            if axis:
                x[axis] ^= swapped
    for axis in range(1, n_axes):
        x[axis] ^= x[axis - 1]
    mirror = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        mirror ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= mirror
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n_axes):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def _curves(dim: int, curves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(SEED)
    axes = min(AXES, dim)
    return [(np.linalg.qr(rng.normal(size=(dim, axes)))[0], rng.uniform(0, 1, axes)) for _ in range(curves)]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _keys(batches: Iterator[pa.RecordBatch], dim: int, longest: float, scale: float, curves: int) -> Iterator[pa.RecordBatch]:
    made = _curves(dim + 1, curves)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        vectors = _matrix(batch.column("vector"))
        norms = np.linalg.norm(vectors, axis=1)
        asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        rest = np.sqrt(np.maximum(longest**2 - norms**2, 0))
        # A query is as long as the longest vector and has nothing in the added dimension.
        points = np.concatenate([
            np.column_stack([vectors, rest]),
            np.column_stack([vectors[asks] * (longest / norms[asks])[:, None], np.zeros(asks.sum())]),
        ])
        ids = batch.column("entry").to_numpy()
        ids, role = np.concatenate([ids, ids[asks]]), np.repeat([0, 1], [len(ids), asks.sum()])
        for curve, (rotation, shift) in enumerate(made):
            unit = np.clip((points @ rotation / (SPREAD * scale) + 1) / 2, 0, 1) * 0.75 + shift * 0.25
            cells = np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), curve, np.int32)), pa.array(hilbert(cells, BITS)), pa.array(ids), pa.array(role.astype(np.int32))],
                ["curve", "key", "entry", "role"],
            )


def _nearest(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` best entries of one block for each query that meets it."""
    role = table.column("role").to_numpy()
    rows, entries = _matrix(table.column("vector")), table.column("entry").to_numpy()
    firsts, alone = table.column("first").to_numpy(), table.column("n").to_numpy() == 1
    order = np.flatnonzero(role == 0)
    order = order[np.lexsort((entries[order], firsts[order]))]
    queries = np.flatnonzero(role == 1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    base = rows[order]
    for low in range(0, len(queries) if len(order) else 0, 256):
        own = queries[low : low + 256]
        scores = rows[own] @ base.T
        # A vector without copies is not its own neighbour.
        scores[(entries[own][:, None] == entries[order][None, :]) & alone[order][None, :]] = -np.inf
        top = min(k, len(order))
        least = np.partition(scores, len(order) - top, axis=1)[:, len(order) - top]
        # Matrix products may differ in the last bits between equal pairs: take in what is
        # as near as that, and compute each pair on its own.
        slack = 1e-9 * np.maximum(np.abs(least), 1e-300)
        q, x = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
        exact = (rows[own[q]] * base[x]).sum(axis=1)
        rank = np.lexsort((x, -exact, q))
        q, x, exact = q[rank], x[rank], exact[rank]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < k
        found.append((entries[own[q[kept]]], entries[order[x[kept]]], exact[kept]))
    columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table({"query": pa.array(columns[0]), "entry": pa.array(columns[1]), "score": pa.array(columns[2])})


def _scanned(batches: Iterator[pa.RecordBatch], asked: np.ndarray, owners: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best entries of one partition for each of a few queries."""
    scores, entries = np.zeros((len(asked), 0)), np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        found = asked @ _matrix(batch.column("vector")).T
        own = batch.column("entry").to_numpy()
        found[owners[:, None] == own[None, :]] = -np.inf
        scores = np.concatenate([scores, found], axis=1)
        entries = np.concatenate([np.broadcast_to(entries, (len(asked), entries.shape[-1])), np.broadcast_to(own, found.shape)], axis=1)
        if scores.shape[1] > k:
            best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            scores, entries = np.take_along_axis(scores, best, 1), np.take_along_axis(entries, best, 1)
    if scores.shape[1]:
        query = np.repeat(owners, scores.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(np.ascontiguousarray(entries).ravel()), pa.array(scores.ravel())], ["query", "entry", "score"])


def _reach(entries: DataFrame, placed: DataFrame, k: int, target: float, sample: int) -> int:
    """Rows to either side of a query within which the share ``target`` of true neighbours is.

    At most ``sample`` queries are scanned for, and their neighbours' places collected.
    """
    some = entries.where("asks").orderBy(F.xxhash64("entry"), "entry").limit(sample).select("entry", "vector").collect()
    asked = np.array([r.vector for r in some], np.float64)
    owners = np.array([r.entry for r in some], np.int64)
    sent = entries.sparkSession.sparkContext.broadcast((asked, owners))
    near = in_small_batches(entries.select("entry", "vector")).mapInArrow(
        lambda batches: _scanned(batches, *sent.value, k), "query bigint, entry bigint, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    near = near.where("score > -1e300").withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k)
    pairs = [(r.query, r.entry) for r in near.select("query", "entry").collect()]  # sample x k
    if not pairs:
        return 1
    wanted = placed.sparkSession.createDataFrame(
        sorted({(x, 0) for _, x in pairs} | {(q, 1) for q, _ in pairs}), "entry bigint, role int")
    rows = placed.join(F.broadcast(wanted), ["entry", "role"]).select("curve", "entry", "role", "place").collect()
    places: dict[tuple[int, int], dict[int, int]] = {}
    for r in rows:
        places.setdefault((r.entry, r.role), {})[r.curve] = r.place
    apart = sorted(min(abs(places[q, 1][c] - at) for c, at in places[x, 0].items()) for q, x in pairs)
    return max(1, apart[int(np.ceil(target * len(apart))) - 1])


def search(
    vectors: DataFrame,
    asks: str,
    k: int = 20,
    window: float | None = None,
    curves: int = CURVES,
    block: int | None = None,
    target: float = TARGET,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row of
    ``vectors(vec_id, embedding)`` for which the SQL condition ``asks`` on ``vec_id`` holds.

    Nearest is the largest inner product in double precision; ties go to the smaller id.
    The reach of a query along a curve is measured (``target``, ``sample``), unless ``window`` gives it
    as a share of all rows; ``block`` is the number of rows that are compared together.
    Rows take no part if the id or the vector is null, or the vector is zero, has a null or
    non-finite component or not as many as most rows (of equally frequent sizes the larger
    counts). Repeated rows count once; an id with several vectors asks with each, and gets
    the best. No usable row: no result.
    """
    # Sums of squares of finite floats can overflow; such a vector has no direction to index.
    usable = vectors.select("vec_id", F.col("embedding").alias("vector")).where(
        "vec_id is not null and exists(vector, x -> x <> 0) and not exists(vector, x -> x is null or isnan(x))"
        " and forall(vector, x -> abs(double(x)) < 1e150)"
    )
    spark = vectors.sparkSession
    sizes = usable.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    dim = sizes.agg(F.max(F.struct("n", "dim"))["dim"]).first()[0] or 0
    usable = usable.where(F.size("vector") == dim)
    entries = usable.groupBy("vector").agg(
        F.min("vec_id").alias("first"), F.count_distinct("vec_id").alias("n"), F.max(F.expr(asks)).alias("asks"))
    entries = stored(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, asking, longest = entries.agg(F.count("*"), F.count_if("asks"), F.max(F.sqrt(square))).first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not asking:
        return spark.createDataFrame([], schema)
    # All points have the norm of the longest; that is spread evenly over the dimensions.
    scale = longest / np.sqrt(dim + 1)
    keyed = in_small_batches(entries.select("entry", "vector", "asks")).mapInArrow(
        lambda batches: _keys(batches, dim, longest, scale, curves), "curve int, key bigint, entry bigint, role int")
    ordered = keyed.repartitionByRange("curve", "key", "entry", "role").sortWithinPartitions("curve", "key", "entry", "role")
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "curves")
    # Ids grow with the partition and then by one: the partitions' sizes make them places.
    part = F.shiftright("at", 33).alias("part")
    sizes = ordered.groupBy(part).agg(F.count("*").alias("rows"))
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    length = n + asking  # of every curve
    placed = ordered.withColumn("part", part).join(before, "part").select(
        "curve", "entry", "role",
        (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("curve") * F.lit(length)).alias("place"))
    if window is None:
        placed = stored(placed, "places")
        reach = _reach(entries, placed, k, target, sample)
    else:
        reach = int(np.ceil(window * length))
    if block is None:
        block = int(np.clip(1 << int(reach).bit_length(), LEAST_BLOCK, BLOCK))
    n_blocks = -(-length // block)
    n_chunks = -(-(2 * reach + block) * asking // (length * CHUNK))
    chunk = F.pmod(F.xxhash64("entry"), F.lit(n_chunks))
    first_block = F.greatest(F.floor((F.col("place") - reach) / block), F.lit(0))
    last_block = F.least(F.floor((F.col("place") + reach) / block), F.lit(n_blocks - 1))
    # A query goes to the blocks that its window touches; a block to each chunk of queries.
    blocks = placed.where("role = 1").select(
        "curve", "entry", "role", F.explode(F.sequence(first_block, last_block)).alias("block"), chunk.alias("chunk"))
    blocks = blocks.union(placed.where("role = 0").select(
        "curve", "entry", "role", F.floor(F.col("place") / block).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_chunks - 1).cast("bigint"))).alias("chunk")))
    met = blocks.join(entries.select("entry", "vector", "first", "n"), "entry")
    near = met.groupBy("curve", "block", "chunk").applyInArrow(
        lambda table: _nearest(table, k + 1), "query bigint, entry bigint, score double")
    near = near.groupBy("query", "entry").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first", "entry")
    near = near.join(entries.select("entry", "first"), "entry").withColumn("turn", F.row_number().over(best))
    near = stored(near.where(F.col("turn") <= k + 1).drop("turn", "first"), "near")

    # Entries back to rows: of many copies the k + 1 of least id are enough, as ties go by id.
    rows = usable.join(entries.select("entry", "vector"), "vector").select("entry", "vec_id").distinct()
    rows = stored(rows, "members")
    few = Window.partitionBy("entry").orderBy("vec_id")
    members = rows.withColumn("turn", F.row_number().over(few)).where(F.col("turn") <= k + 1).drop("turn")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = near.join(members, "entry").withColumn("turn", F.row_number().over(nearest)).where(F.col("turn") <= k + 1)
    # Written out: next to the window the join would keep all rows that ask with one vector in one task.
    lists = stored(lists, "lists")
    asked = rows.where(F.expr(asks)).select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
    # Without itself, a query has k left of the k + 1, if there are so many.
    found = asked.join(lists.select("query", "vec_id", "score"), "query").where("vec_id <> query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
