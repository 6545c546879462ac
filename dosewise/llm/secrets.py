"""Secrets in texts: fixed patterns, and random strings told from ordinary identifiers.

Two character Markov models, one of random strings and one of identifiers, are trained
from labelled samples. A long token is called random if its log-likelihood ratio under the
two, per character step, is large enough. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.tables import same

# Fixed values. A run of 24 or more of a character set, found leftmost, is the same as any
# run of it of which the short ones are dropped; so is the access key with its 16 more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "markov"]

# Long tokens with a letter and a digit: the only ones the models judge.
TOKEN_CHARS = r"A-Za-z0-9+/_=-"
LEAST_TOKEN = 12  # characters; of shorter ones too many are words
FIRST_CODE, CODES = 43, 80  # "+" to "z"
THRESHOLD = 0.5
BACK_OFF = 5.0  # weight of a character's own frequency against the steps seen
SAMPLE_DOCS = 400  # documents whose words and base matches are the labelled samples
DIGESTS = 400  # random strings that every sample holds
DOC = ["doc_id", "text_h"]


def token_pattern(least: int) -> str:
    """Tokens of ``least`` characters or more, of which one is a letter and one a digit."""
    return rf"(?<![{TOKEN_CHARS}])(?=[{TOKEN_CHARS}]*?[0-9])(?=[{TOKEN_CHARS}]*?[A-Za-z])[{TOKEN_CHARS}]{{{least},}}"


def _codes(token: Column) -> Column:
    plain = F.filter(F.split(token, ""), lambda c: c != "")
    return F.transform(plain, lambda c: (F.ascii(c) - FIRST_CODE).cast("int"))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``token, random`` (1 or 0).

    Random are digests of counters as hexadecimal, base64 and upper-case base32-like text, and
    what the fixed patterns match in at most ``sample_docs`` documents of least hashed id that
    have a match. Ordinary are the words of as many documents, alone and joined to identifiers.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "2"))
    digests = spark.range(DIGESTS).select(
        F.explode(F.array(digest, F.substring(digest, 1, 40), F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), upper)).alias("token"))

    text = F.coalesce("text", F.lit(""))
    # The sample is chosen by ids, so that no task gathers texts that are not in it.
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_h"), F.rlike(text, F.lit(f"{HEX}|{ACCESS}")).alias("match"))
    order = [F.xxhash64("doc_id"), "text_h", "doc_id"]
    chosen = keyed.where("match").orderBy(*order).limit(sample_docs).withColumn("role", F.lit("match"))
    chosen = chosen.union(keyed.orderBy(*order).limit(sample_docs).withColumn("role", F.lit("words")))
    chosen = chosen.select(F.col("doc_id").alias("its_id"), F.col("text_h").alias("its_h"), "role").distinct()
    mine = same(F.col("doc_id"), F.col("its_id")) & (F.xxhash64("text") == F.col("its_h"))
    # At most 2 x ``sample_docs`` ids; rows that repeat a document count once.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), mine).select("doc_id", "its_h", "text", "role").distinct()
    matching, others = sample.where("role = 'match'"), sample.where("role = 'words'")
    matched = matching.select(F.explode(F.regexp_extract_all(text, F.lit(f"({HEX}|{ACCESS})"), 1)).alias("token"))
    words = F.regexp_extract_all(text, F.lit("([A-Za-z]{2,24})"), 1)

    def with_joined(own: Column) -> Column:
        return F.concat(own, F.transform(own, lambda w, i: F.concat_ws("_", w, F.get(own, i + 1), (i % 100).cast("string"))))

    # The words are computed once a text and handed on.
    ordinary = others.select(F.explode(F.get(F.transform(F.array(words), with_joined), 0)).alias("token"))
    return digests.union(matched).withColumn("random", F.lit(1)).union(ordinary.withColumn("random", F.lit(0)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, random against ordinary.

    First-order models that back off to the frequency of the second character alone, which
    starts from one; null tokens and labels are left out. The table has ``CODES`` squared
    entries whatever the size of the samples.
    """
    given = samples.where("token is not null and random is not null").select("random", _codes(F.col("token")).alias("c"))
    steps = given.where(F.size("c") > 1).select("random", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.get("c", i) * CODES + F.get("c", i + 1))).alias("step"))
    counts = {(r.random, r.step): r.n for r in steps.where(f"step >= 0 and step < {CODES * CODES}").groupBy("random", "step").agg(
        F.count("*").alias("n")).collect()}
    chances = []
    for y in (0, 1):
        steps_of = [[counts.get((y, a * CODES + b), 0) for b in range(CODES)] for a in range(CODES)]
        into = [sum(row[b] for row in steps_of) for b in range(CODES)]
        plain = [(n + 1) / (sum(into) + CODES) for n in into]
        chances.append([
            (n + BACK_OFF * plain[b]) / (sum(row) + BACK_OFF) for row in steps_of for b, n in enumerate(row)])
    table = [math.log(rand / ordinary) for ordinary, rand in zip(*chances)]
    return table


def ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's character steps; 0 for fewer than two characters."""
    ratios = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")  # folded once

    def of(c: Column) -> Column:
        steps = F.sequence(F.lit(0), F.size(c) - 2)
        total = F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.coalesce(F.get(ratios, F.get(c, i) * CODES + F.get(c, i + 1)), F.lit(0.0)))
        return F.when(F.size(c) > 1, total / (F.size(c) - 1)).otherwise(0.0)

    return F.get(F.transform(F.array(_codes(token)), of), 0)


def _found(text: Column, kind: int, pattern: str, value: Column) -> Column:
    """Lengths of the stretches before each match and after the last, the matches, their values.
    Most texts have no match: they pay for one search only."""
    return F.when(F.rlike(text, F.lit(pattern)), F.struct(
        F.lit(kind).alias("kind"),
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap)).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        value.alias("values"),
    ))


def spans(docs: DataFrame, table: list[float], threshold: float = THRESHOLD, least_token: int = LEAST_TOKEN) -> DataFrame:
    """``doc_id, text_h, kind, start, end, value``: every span once per document, ``kind`` as
    its number in ``KINDS``, offsets in code points, end exclusive.

    A random token of ``least_token`` characters or more is a span unless it overlaps one of a
    fixed pattern.
    """
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast("array<string>")
    found = F.array(
        _found(text, 0, ASSIGN, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))),
        _found(text, 1, ACCESS, nothing),
        _found(text, 2, HEX, nothing),
        _found(text, 3, token_pattern(least_token), nothing),
    )
    each = docs.select("doc_id", F.xxhash64("text").alias("text_h"), F.explode(found).alias("f")).where("f is not null")
    each = each.select(*DOC, "f.kind", F.posexplode(F.arrays_zip("f.gaps", "f.matches", "f.values")).alias("n", "m"))
    # The last gap has no match, but rows before it need no more than their own.
    each = each.select(*DOC, "kind", "n", "m.gaps", "m.matches", F.col("m.values").alias("value")).where("matches is not null").distinct()
    run = Window.partitionBy(*DOC, "kind").orderBy("n")
    end = F.sum(F.col("gaps") + F.length("matches")).over(run)
    placed = each.select(*DOC, "kind", "matches", "value", end.alias("end"), (end - F.length("matches")).alias("start"))
    good = F.when(F.col("kind") == 0, F.length("value") >= LEAST_VALUE).when(
        F.col("kind") == 3, ratio(F.col("matches"), table) >= threshold).otherwise(True)
    placed = placed.where(good)
    doc = Window.partitionBy(*DOC).orderBy("start", "kind")
    base = F.col("kind") < 3
    earlier = F.max(F.when(base, F.col("end"))).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(base, F.col("start"))).over(doc.rowsBetween(1, Window.unboundedFollowing))
    checked = placed.withColumn("earlier", earlier).withColumn("later", later)
    free = (F.coalesce("earlier", F.lit(-1)) <= F.col("start")) & (F.coalesce("later", F.col("end")) >= F.col("end"))
    return checked.where(base | free).select(*DOC, "kind", "start", "end", F.col("matches").alias("value"))


def scan(docs: DataFrame, table: list[float], threshold: float = THRESHOLD, least_token: int = LEAST_TOKEN) -> DataFrame:
    """``doc_id, text_h, n_assign, n_access, n_hex, n_markov, base, spans``, a row per row of
    ``docs``; the last two are the spans as ``kind:start:end``, by start and kind, with commas.

    Null texts are empty and have no spans; rows equal in id and text have the same.
    """
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    written = F.concat_ws(":", name, "start", "end")
    listed = spans(docs, table, threshold, least_token).groupBy(*DOC).agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.struct("start", "kind", written.alias("s")))).alias("all"),
    ).withColumnsRenamed({"doc_id": "its_id", "text_h": "its_h"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_h"))
    joined = rows.join(listed, same(rows.doc_id, listed.its_id) & (rows.text_h == listed.its_h), "left")
    everything = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,s:string>>"))

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: s["s"]), ",")

    return joined.select(
        *DOC, *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        text_of(F.filter(everything, lambda s: s["kind"] < 3)).alias("base"), text_of(everything).alias("spans"),
    )
