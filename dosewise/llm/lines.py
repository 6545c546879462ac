"""Repeated runs of lines, found by a suffix array over line-id sequences.

Every document is a sequence of line ids. Ranks of suffixes by their first 1, 2, 4, ...
lines come from prefix doubling: the rank for 2h lines orders pairs of ranks for h lines,
``h`` lines apart, by a range-partitioned sort. Suffixes that share a rank form an LCP
interval of that depth. A suffix alone in its interval is in no repeated run, so only
lines with copies are ranked, and each further depth ranks fewer.

A run counts if it has ``min_chars`` characters, line ends included. Every line of a
repeated run of that size lies in a smallest such run that starts at the run's start, or in
a smallest one that ends at the line. These smallest runs have at most ``min_chars`` lines,
which bounds the doubling, and two ranks of the largest power of two that fits name each
of them exactly. Each one whose interval has an earlier member is a later copy; together
they cover just the maximal repeated runs that have an earlier copy.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.tables import same, stored

MIN_CHARS = 25
DOC = ["doc_id", "text_h"]


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _ranked(pairs: DataFrame) -> DataFrame:
    """``a, b, rank`` for every pair with at least two suffixes, in the order of (a, b).

    Ids grow with the partition, and partitions are ranges, so the id is the rank, with gaps.
    """
    shared = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    ordered = shared.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    return stored(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def copied_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_h, line``: the lines (from 0) inside later copies of repeated runs.

    Of equal runs the one first by doc_id (null first), text hash and line is kept. Rows
    equal in id and text count as one document.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_h"), F.posexplode(_split(F.col("text"))))
    lines = lines.select(
        *DOC,
        F.col("pos").alias("line"),
        F.xxhash64("col").alias("a"),
        F.xxhash64(F.lit("second"), "col").alias("b"),  # 128 bits tell lines apart
        (F.length("col") + 1).alias("size"),
    )
    first = _ranked(lines)
    # Only lines with copies go on; the hot ones are split, not gathered.
    kept = stored(lines.join(first, ["a", "b"]).select(*DOC, "line", "size", F.col("rank").alias("r0")).distinct(), "lines")

    doc = Window.partitionBy(*DOC).orderBy("line")
    kept = kept.withColumn("island", F.col("line") - F.row_number().over(doc))
    run = Window.partitionBy(*DOC, "island").orderBy("line")
    kept = kept.withColumn("after", F.sum("size").over(run)).withColumn("before", F.col("after") - F.col("size"))
    ahead = Window.partitionBy(*DOC, "island").orderBy("before").rangeBetween(0, min_chars - 1)
    behind = Window.partitionBy(*DOC, "island").orderBy("after").rangeBetween(-(min_chars - 1), 0)
    kept = kept.withColumns({
        "ahead": F.count("*").over(ahead),
        "ahead_size": F.max("after").over(ahead) - F.col("before"),
        "behind": F.count("*").over(behind),
        "behind_size": F.col("after") - F.min("before").over(behind),
    })
    kept = stored(kept.select(
        *DOC, "line", "island", "r0",
        F.when(F.col("ahead_size") >= min_chars, F.col("ahead")).alias("ahead"),
        F.when(F.col("behind_size") >= min_chars, F.col("behind")).alias("behind"),
    ), "runs")

    longest = kept.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    top = max(int(longest).bit_length() - 1, 0)
    for level in range(top):
        pairs = kept.withColumn("other", F.lead(f"r{level}", 1 << level).over(run))
        # Suffixes alone in their interval, or cut off by a line without copies, drop out.
        ranks = _ranked(pairs.where(f"r{level} is not null and other is not null").select(
            F.col(f"r{level}").alias("a"), F.col("other").alias("b")))
        kept = pairs.join(ranks, (pairs[f"r{level}"] == ranks.a) & (pairs.other == ranks.b), "left")
        kept = stored(kept.drop("a", "b", "other").withColumnRenamed("rank", f"r{level + 1}"), "suffixes")

    def by_level(n_lines: Column, column: str) -> Column:
        return F.coalesce(*[
            F.when((n_lines >= 1 << level) & (n_lines < 2 << level), F.col(f"{column}{level}"))
            for level in range(top + 1)
        ])

    ends = kept.select(
        *DOC, F.col("line").alias("last"),
        *[F.lag(f"r{level}", (1 << level) - 1).over(run).alias(f"t{level}") for level in range(top + 1)],
    )
    smallest = kept.where("ahead is not null").select(
        *DOC, F.col("line").alias("start"), F.col("ahead").alias("n_lines"))
    smallest = smallest.union(kept.where("behind is not null").select(
        *DOC, (F.col("line") - F.col("behind") + 1).alias("start"), F.col("behind").alias("n_lines"))).distinct()
    starts = kept.select(*DOC, F.col("line").alias("start"), *[f"r{level}" for level in range(top + 1)])

    def at(left: DataFrame, right: DataFrame, line: Column, other: str) -> DataFrame:
        right = right.withColumnsRenamed({"doc_id": "its_id", "text_h": "its_h", other: "its_line"})
        on = same(F.col("doc_id"), F.col("its_id")) & (F.col("text_h") == F.col("its_h")) & (line == F.col("its_line"))
        return left.join(right, on).drop("its_id", "its_h", "its_line")

    named = at(smallest, starts, F.col("start"), "start")
    named = at(named, ends, F.col("start") + F.col("n_lines") - 1, "last")
    named = named.select(
        *DOC, "start", "n_lines",
        by_level(F.col("n_lines"), "r").alias("head"), by_level(F.col("n_lines"), "t").alias("tail"),
    ).where("head is not null and tail is not null")
    named = stored(named.withColumn("place", F.struct(*DOC, "start")), "named")
    key = ["n_lines", "head", "tail"]
    earliest = named.groupBy(*key).agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1")
    # Written out, so that the join does not lean on the layout of the sum: it can be split.
    later = named.join(stored(earliest, "earliest"), key).where("place > earliest")
    covered = F.explode(F.sequence(F.col("start").cast("int"), (F.col("start") + F.col("n_lines") - 1).cast("int")))
    return later.select(*DOC, covered.alias("line")).distinct()


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines of ``copied_lines``; a document that loses every line goes.

    All columns are kept, others than the text as they are. Null and empty texts stay.
    """
    gone = copied_lines(docs, min_chars).groupBy(*DOC).agg(F.collect_set("line").alias("gone_lines"))
    gone = gone.withColumnsRenamed({"doc_id": "gone_id", "text_h": "gone_h"})
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("own_h"))
    on = same(F.col("doc.doc_id"), F.col("gone_id")) & (F.col("own_h") == F.col("gone_h"))
    all_lines = _split(F.col("doc.text"))
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone_lines"))
    text = F.array_join(F.transform(left, lambda i: F.get(F.col("all_lines"), i)), "\n")
    joined = given.join(gone, on, "left").withColumn("all_lines", all_lines).withColumn("left_lines", left)
    joined = joined.where("gone_lines is null or size(left_lines) > 0")
    shown = F.when(F.col("gone_lines").isNull(), F.col("doc.text")).otherwise(text)
    return joined.select(*[
        shown.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns
    ])
