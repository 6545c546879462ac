"""The constraint report over all tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.sources.contracts import CONTRACTS, TYPES, Contract, Reference
from dosewise.sources.tables import Tables

NOT_NULL, KEY, REFERENCE, CHECK = "not null", "primary key", "foreign key", "check"


# Seeds of the two halves of a key's hash, and bits of a further one beside the number of a place.
HALVES = (11, 12)
FURTHER = 24


@dataclass(frozen=True)
class Rule:
    """``place`` is where a rule's rows meet; ``bit`` stands for what a row breaks by itself."""

    contract: Contract
    name: str
    kind: str
    place: int
    bit: int = 0
    reference: Reference | None = None


def _own_order(ref: Reference) -> list[str]:
    """The child's columns in the order of the parent's key."""
    paired = dict(zip(ref.parent_columns, ref.columns))
    if set(paired) != set(CONTRACTS[ref.parent].key):
        raise ValueError(f"reference {ref.label} is not to the key of {ref.parent}")
    return [paired[c] for c in CONTRACTS[ref.parent].key]


def _rules(t: Tables) -> tuple[list[Rule], dict[str, list[int]]]:
    """Every rule whose tables are given, and the places where each table says its keys.

    Keys of a table and the first reference to it meet at the table's number. Each further
    reference has a place of its own, where the keys are said again: so a key is counted
    twice at most, as a key and as a reference. What a row breaks by itself is a bit of
    one number, at another place of its table.
    """
    keyed = {name: [i] for i, name in enumerate(t)}
    free = count(2 * len(keyed))
    referred: set[str] = set()
    rules: list[Rule] = []
    for i, name in enumerate(t):
        contract = CONTRACTS[name]
        single = [(c, NOT_NULL) for c in contract.columns] + [(c, CHECK) for c in contract.row_checks]
        rules += [Rule(contract, rule, kind, len(keyed) + i, bit) for bit, (rule, kind) in enumerate(single)]
        rules.append(Rule(contract, ", ".join(contract.key), KEY, i))
        for ref in contract.references:
            if ref.parent in t:
                if ref.parent in referred:
                    keyed[ref.parent].append(next(free))
                referred.add(ref.parent)
                rules.append(Rule(contract, ref.label, REFERENCE, keyed[ref.parent][-1], reference=ref))
    return rules, keyed


def _halves(marked: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *marked) for seed in HALVES]


def _meeting(place: int, is_key: bool, cells: list[Column]) -> Column:
    # A hash passes over missing cells, so which ones are missing is hashed too.
    marked = [x for c in cells for x in (c, c.isNull())]
    one, other = _halves(marked)
    further = F.hash(*marked).bitwiseAND(F.lit((1 << FURTHER) - 1))
    return F.struct(
        F.lit(place << FURTHER).bitwiseOR(further).alias("place"), one.alias("one"), other.alias("other"), F.lit(is_key).alias("is_key"))


def _said(df: DataFrame, rules: list[Rule], keyed: list[int]) -> DataFrame:
    """``place, one, other, is_key``: the key of each row, the keys it refers to (one
    with a missing cell says nothing), and, if it breaks something by itself, what."""
    found = []
    broken = F.lit(0).cast("bigint")
    for rule in rules:
        parent = rule.contract if rule.reference is None else CONTRACTS[rule.reference.parent]
        if rule.kind in (NOT_NULL, CHECK):
            wrong = F.col(rule.name).isNull() if rule.kind == NOT_NULL else ~F.expr(rule.name)
            broken = broken + F.when(wrong, F.lit(1 << rule.bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            single = rule.place
            continue
        own = list(rule.contract.key) if rule.kind == KEY else _own_order(rule.reference)
        # As the key's type, so that equal keys have equal hashes.
        cells = [F.col(c).cast(TYPES[parent.columns[k]]) for c, k in zip(own, parent.key)]
        if rule.kind == KEY:
            found += [_meeting(place, True, cells) for place in keyed]
        else:
            found.append(F.when(reduce(and_, [c.isNotNull() for c in cells]), _meeting(rule.place, False, cells)))
    bits = F.struct(
        F.lit(single << FURTHER).alias("place"), broken.alias("one"), F.lit(0).cast("bigint").alias("other"), F.lit(True).alias("is_key"))
    found.append(F.when(broken != 0, bits))
    return df.select(F.explode(F.array(*found)).alias("said")).where("said is not null").select("said.*")


def _together(parts: list[DataFrame]) -> DataFrame:
    # Pairing halves keeps the plan shallow: a chain is analysed anew at every link.
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _together(parts[:middle]).union(_together(parts[middle:]))


def validate(t: Tables) -> DataFrame:
    """``(table, constraint, kind, violations)`` for every declared rule, zeros included.

    One scan per table, one shuffle for all. Rows say their keys and references as hashes of
    128 bits, which are counted before they are shuffled: a key that half the rows point to
    sends a row per task. Most keys are of one row and take a place in a task's memory each, so
    they carry two counts and nothing else. Equal keys of one table then meet, and references
    without a key there are orphans. What a row breaks by itself travels as one number, and
    only if there is something. ``FURTHER`` more bits, in the same cell as the place, tell
    apart keys that share those. Rules whose tables are not given are left out.
    """
    rules, keyed = _rules(t)
    if max(r.place for r in rules) >> (31 - FURTHER):
        raise ValueError("too many references for the bits of a place")
    bits = max(r.bit for r in rules) + 1
    said = _together([_said(t[name], [r for r in rules if r.contract.table == name], keyed[name]) for name in t])
    met = said.groupBy("place", "one", "other").agg(
        F.count_if(F.col("is_key")).alias("keys"), F.count_if(~F.col("is_key")).alias("refs"))
    met = met.withColumn("place", F.shiftright("place", FURTHER))
    is_single = F.col("place").between(len(t), 2 * len(t) - 1)
    copies = F.sum(F.when(~is_single, F.greatest(F.col("keys") - 1, F.lit(0)))).alias(KEY)
    orphans = F.sum(F.when(~is_single & (F.col("keys") == 0), F.col("refs"))).alias(REFERENCE)
    broken = [F.sum(F.when(is_single & (F.col("one").bitwiseAND(F.lit(1 << b)) != 0), F.col("keys"))).alias(f"b{b}") for b in range(bits)]
    totals = met.groupBy("place").agg(copies, orphans, *broken)
    cells = [F.struct(F.lit(c).alias("cell"), F.col(c).alias("found")) for c in (KEY, REFERENCE, *[f"b{b}" for b in range(bits)])]
    totals = totals.select("place", F.inline(F.array(*cells)))
    named = F.array(*[
        F.struct(
            F.lit(r.place).alias("place"), F.lit(r.kind if r.kind in (KEY, REFERENCE) else f"b{r.bit}").alias("cell"),
            F.lit(r.contract.table).alias("table"), F.lit(r.name).alias("constraint"), F.lit(r.kind).alias("kind"))
        for r in rules
    ])
    every = t[rules[0].contract.table].sparkSession.range(1).select(F.inline(named))
    report = every.join(totals, ["place", "cell"], "left")
    return report.select("table", "constraint", "kind", F.coalesce("found", F.lit(0)).cast("bigint").alias("violations"))
