"""URLs allowed or blocked by rules, and where no rule fits by logistic regression on
hashed character n-grams of host and path.

DataFrame functions only. Training is batch gradient descent from zero, written in the
weights of the samples: the weight vector is always a sum of the samples' n-gram vectors,
so each step updates one number a sample from their inner products. The labelled table is
small by definition; its size is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
BINS = 16381
BASE = 1009
RATE = 0.5
DECAY = 0.01
STEPS = 200
MOST_SAMPLES = 2000

Rule = tuple[str, str]  # "allow" or "block", and host followed by a path prefix


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of ``verdict`` and ``rule`` of the longest rule that fits, null if none does.
    Of rules as long as each other the first by text, and block before allow, wins."""
    chain = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]], r[0])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rule_path))
        chain = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(chain)
    return chain


def _grams(text: Column, kind: int) -> Column:
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))

    def bin_at(codes: Column, i: Column) -> Column:
        value = F.lit(kind).cast("bigint")
        for n in range(GRAM):
            value = (value * BASE + F.get(codes, i + n)) % BINS
        return value

    starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(0), F.length(text) - GRAM)).otherwise(F.array().cast("array<int>"))
    # The codes are computed once and handed on, not once a gram.
    once = F.transform(F.array(codes), lambda own: F.transform(starts, lambda i: bin_at(own, i)))
    return F.filter(F.get(once, 0), lambda g: g.isNotNull())


def grams(host: Column, path: Column) -> Column:
    """Bins of the character n-grams of the host, its ends marked, and of the path."""
    return F.concat(_grams(F.concat(F.lit("^"), host, F.lit("$")), 1), _grams(path, 2))


def train(labelled: DataFrame) -> tuple[float, list[float]]:
    """Bias and weight per bin from ``labelled(url, block)``, ``block`` being 1 or 0.

    Rows with a null label are left out, null urls are empty ones. No rows: all weights zero.
    """
    n = labelled.where("block is not null").count()
    if n > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} labelled urls")
    if n == 0:
        return 0.0, [0.0] * BINS
    rows = labelled.where("block is not null").select(F.col("url"), F.col("block").cast("double").alias("y"))
    # A bounded table: one row holds its samples in a fixed order.
    samples = rows.groupBy().agg(F.sort_array(F.collect_list(F.struct("url", "y"))).alias("all"))
    samples = samples.select(F.posexplode("all").alias("id", "row")).select(
        "id", "row.y", grams(host_of(F.col("row.url")), path_of(F.col("row.url"))).alias("grams"))
    total = F.sqrt(F.size("grams").cast("double"))
    vectors = samples.select("id", total.alias("norm"), F.explode("grams").alias("bin"))
    vectors = vectors.groupBy("id", "bin").agg((F.count("*") / F.first("norm")).alias("x"))
    other = vectors.select(F.col("id").alias("other"), "bin", F.col("x").alias("z"))
    products = vectors.join(other, "bin").groupBy("id", "other").agg(F.sum(F.col("x") * F.col("z")).alias("k"))
    row = products.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("other", "k"))).alias("ks"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda t: F.coalesce(F.try_element_at("ks", t), F.lit(0.0)) + 1)
    empty = F.create_map().cast("map<int,double>")
    row = samples.join(row, "id", "left").withColumn("ks", F.coalesce("ks", empty)).select("id", "y", dense.alias("ks"))
    problem = row.groupBy().agg(F.sort_array(F.collect_list(F.struct("id", "y", "ks"))).alias("s"))

    def step(alphas: Column, _: Column) -> Column:
        def moved(sample: Column, i: Column) -> Column:
            eta = F.aggregate(
                F.zip_with(alphas, sample["ks"], lambda a, k: a * k), F.lit(0.0), lambda total, x: total + x)
            return F.get(alphas, i) * (1 - RATE * DECAY) + (sample["y"] - 1 / (1 + F.exp(-eta))) * RATE

        return F.transform(F.col("s"), moved)

    start = F.transform(F.col("s"), lambda _: F.lit(0.0))
    alphas = problem.select(F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)).alias("id", "alpha"))
    weights = vectors.join(alphas, "id").groupBy("bin").agg(F.sum(F.col("alpha") * F.col("x")).alias("w"))
    known = {r.bin: r.w for r in weights.collect()}  # bounded by BINS
    bias = alphas.agg(F.sum("alpha")).first()[0]
    return bias, [known.get(i, 0.0) for i in range(BINS)]


def blocked(host: Column, path: Column, model: tuple[float, list[float]]) -> Column:
    """Probability that the url is one to block."""
    bias, weights = model
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded once
    found = grams(host, path)
    total = F.aggregate(found, F.lit(0.0), lambda s, g: s + F.get(table, g.cast("int")))
    mean = F.when(F.size(found) > 0, total / F.sqrt(F.size(found).cast("double"))).otherwise(0.0)
    return 1 / (1 + F.exp(-(mean + bias)))


def judge(pages: DataFrame, rules: Sequence[Rule], model: tuple[float, list[float]]) -> DataFrame:
    """All columns of ``pages`` but ``host, path, rule, verdict, probability``, and those five.

    One row for each row of ``pages``; a url that is null or without ``://`` has an empty
    host and path. The rule decides; without one, the probability of block does, at 0.5.
    """
    made = ["host", "path", "rule", "verdict", "probability"]
    given = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    parts = pages.select(*given, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    parts = parts.withColumn("probability", blocked(F.col("host"), F.col("path"), model))
    guess = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    return parts.select(
        *given, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", guess).alias("verdict"), "probability",
    )
