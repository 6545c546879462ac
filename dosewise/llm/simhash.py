"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint's eight bytes are eight postings (position, byte). Two fingerprints that
differ in at most ``max_bits`` bits share at least ``8 - max_bits`` postings, so with the
positions dealt into ``max_bits + 2`` groups they share two whole groups. The index is
therefore opened by pairs of groups: a list holds the fingerprints with the same bytes in
both. Pairs from a list tally their shared positional bytes, those that reach the
guaranteed minimum stay, and the bit distance settles them.

A list of many different fingerprints would make quadratically many pairs. Its members
agree in the list's bytes, so those within ``max_bits`` of each other have a common
midpoint at most ``max_bits / 2`` flips of the other bits away from both: each member
names its midpoints, and members with the same midpoint link. No link is lost, and a
midpoint has few members by construction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.llm.batches import segment_sums, text_slices
from dosewise.llm.components import components
from dosewise.llm.tables import drop, in_small_batches, stored

BYTES = 8
SHINGLE = 3
MAX_BITS = 2
SEED = 42  # fixed value
LIST_LIMIT = 64


def fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Per text: the 64 bits that more than half of its shingles' XXH64 have set."""
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        found = []
        for part in text_slices(batch.column("text")):
            hashes, counts = [], np.zeros(len(part), np.int64)
            for i in range(len(part)):
                words = part.text(i).lower().split()  # of bytes: ASCII letters and white space only
                if len(words) <= shingle:
                    own = [digest(b" ".join(words), SEED)] if words else []
                else:
                    joined = b" ".join(words)
                    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
                    starts = [0, *ends]
                    own = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
                counts[i] = len(own)
                hashes += own
            bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
            ends = np.cumsum(counts)
            ones = segment_sums(bits, ends - counts, ends)
            major = np.packbits(ones * 2 > counts[:, None], axis=1)
            found.append(np.ascontiguousarray(major).view(">u8").ravel().astype(np.uint64).view(np.int64))
        column = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in batch.schema.names if k != "text"), column],
                                         [*(k for k in batch.schema.names if k != "text"), "fingerprint"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_h, fingerprint`` for every row; null texts count as empty."""
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(given).mapInArrow(
        lambda batches: fingerprint_batches(batches, shingle), f"doc_id {kind}, text_h bigint, fingerprint bigint"
    )


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(255 << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _lists(max_bits: int) -> list[tuple[int, ...]]:
    """The byte positions of each posting list: all pairs of position groups."""
    groups = [tuple(range(i, BYTES, max_bits + 2)) for i in range(max_bits + 2)]
    return [a + b for a, b in combinations(groups, 2)]


def links(classes: DataFrame, max_bits: int = MAX_BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """``(u, v)`` over distinct ``classes.fingerprint``: every link, or, in long posting
    lists, enough links to connect what is linked."""
    if max_bits not in (0, 2, 4):
        raise ValueError("max_bits must be 0, 2 or 4")
    lists = _lists(max_bits)
    opened = F.array(*[
        F.struct(F.lit(i).alias("list"), F.col("fingerprint").bitwiseAND(F.lit(_mask(p))).alias("key"))
        for i, p in enumerate(lists)
    ])
    postings = classes.select("fingerprint", F.explode(opened).alias("posting"))
    postings = postings.select("fingerprint", "posting.list", "posting.key")
    # A list of one has no pair: most postings end here, before any join of their rows. The
    # sizes are written, so that the join does not keep a list in one task, as their sum does.
    sizes = stored(postings.groupBy("list", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    open_lists = stored(postings.join(sizes, ["list", "key"]), "postings")
    drop(sizes)

    short = open_lists.where(F.col("n") <= list_limit)
    left = short.select("list", "key", F.col("fingerprint").alias("u"))
    right = short.select("list", "key", F.col("fingerprint").alias("v"))
    pairs = left.join(right, ["list", "key"]).where("u > v")
    tally = sum((_byte(F.col("u"), p) == _byte(F.col("v"), p)).cast("int") for p in range(BYTES))
    pairs = pairs.where(tally >= BYTES - max_bits)
    pairs = pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).select("u", "v")

    flips = [
        (i, sum(1 << bit for bit in chosen))
        for i, positions in enumerate(lists)
        for n in range(max_bits // 2 + 1)
        for chosen in combinations([b for b in range(64) if b // 8 not in positions], n)
    ]
    long = open_lists.where(F.col("n") > list_limit)
    by_list = F.array(*[
        F.array(*[F.lit(f - (1 << 64) if f >> 63 else f).cast("bigint") for k, f in flips if k == i])
        for i in range(len(lists))
    ])
    midpoints = long.select("list", "key", "fingerprint", F.explode(F.get(by_list, F.col("list"))).alias("flip"))
    midpoints = midpoints.groupBy("list", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("midpoint"))
    # At most 1 + (free bits) members for two bits: a fixed bound, whatever the data.
    stars = midpoints.agg(F.collect_set("fingerprint").alias("members")).where(F.size("members") > 1)
    stars = stars.select(F.explode("members").alias("u"), F.array_min("members").alias("v")).where("u <> v")
    return pairs.union(stars)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, list_limit: int = LIST_LIMIT
) -> DataFrame:
    """``doc_id, text_h, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links of at most ``max_bits``
    differing bits. Rows with the same fingerprint are one class, so copies never meet in
    pairs. Null and empty texts have fingerprint zero, linked like any other. Repeated
    rows all come back; a null doc_id counts in no minimum, and a component of null ids
    only has a null id. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, max_bits, list_limit))
    linked = classes.join(roots, classes.fingerprint == roots.node)
    least = stored(linked.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    moved = roots.join(least, "root").select(F.col("node").alias("fingerprint"), F.col("component_id").alias("least"))
    labels = classes.join(moved, "fingerprint", "left")
    labels = labels.select("fingerprint", F.coalesce("least", "first").alias("component_id"))
    # Written out, so that the last join is a plain one that can split a hot fingerprint.
    labels = stored(labels, "labels")
    return prints.join(labels, "fingerprint").select("doc_id", "text_h", "fingerprint", "component_id")


def hex_fingerprint(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the least doc_id,
    and of several such rows that with the least text hash. Of rows alike in id and text the
    one stays whose other columns have the least hash (maps have no hash and do not count).

    Components are told apart by their fingerprints: ids may be null or repeated.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_h")
    # One class may hold a third of all rows: least rows are found by a sum, not by sorting.
    classes = stored(prints.groupBy("fingerprint").agg(F.min(order).alias("first")), "classes")
    roots = components(links(classes, max_bits))
    root = F.coalesce("root", "fingerprint").alias("root")
    rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select(root, "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"))
    kept = stored(kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_h").alias("kept_h")).distinct(), "kept")
    # Columns of either frame by name would be ambiguous if documents have a kept_id too.
    mine = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_h"])
    found = docs.join(kept, mine, "left_semi")
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    if not others:
        return found.distinct()
    hashed = [f"`{f.name}`" for f in docs.schema if f.name in others and "map<" not in f.dataType.simpleString()]
    rest = F.struct(*[f"`{c}`" for c in others])
    least = found.groupBy("doc_id", "text").agg(F.min_by(rest, F.xxhash64(F.lit(0), *hashed)).alias("rest"))
    return least.select(*["doc_id" if c.lower() == "doc_id" else "text" if c.lower() == "text" else F.col("rest")[c].alias(c) for c in docs.columns])
