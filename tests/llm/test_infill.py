import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dosewise.llm import infill
from dosewise.llm.batches import text_slices

ALPHABET = ["a", "é", "中", "🙂", "\n", "<", "P", ">", "\x00", "́", " ", "�", "\U0010ffff"]


def lines_of(text):
    found = text.split("\n")
    return [x + "\n" for x in found[:-1]] + ([found[-1]] if found[-1] else [])


def expected(doc_id, text, unit=infill.CODE_POINT, seed=1):
    """The contract, unit by unit."""
    text = text or ""
    units = list(text) if unit == infill.CODE_POINT else lines_of(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def corpus():
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "x", "🙂", "<P>", "a<S>b", "<M", "<<P", "\n", "\n\n", "no end", "end\n", "é" * 200_000, "a\n" * 100_000]
    rows = list(enumerate(texts))
    return rows + [(3, texts[3]), (3, "another text"), (None, "without an id"), (None, None), (-7, "below zero")]


@pytest.mark.parametrize("unit", [infill.CODE_POINT, infill.LINE])
def test_against_brute_force(spark, unit):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = infill.fill_in_middle(docs, unit=unit)
    back = infill.restored(F.col("form"), F.col("output"))
    found = made.select("doc_id", "n", "form", "prefix_units", "middle_units", "output", back.alias("text")).collect()
    wanted = [expected(i, t, unit) for i, t in rows]
    assert sorted(map(str, [tuple(r)[:6] for r in found])) == sorted(map(str, wanted))
    assert sorted(r.text for r in found) == sorted(t or "" for _, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_select_finds_every_unit():
    texts = ["", "aé中🙂", "x" * 17, "🙂🙂🙂", "é", "", "中" * 40]
    (part,) = text_slices(pa.array(texts))
    units = infill.Units(part)
    ends = [int(s) + len(t[: i + 1].encode()) for s, t in zip(part.starts, texts) for i in range(len(t))]
    assert units.after(np.arange(1, len(ends) + 1)).tolist() == ends
    assert units.before(np.arange(len(part.data) + 1)).tolist() == [sum(e <= at for e in ends) for at in range(len(part.data) + 1)]


def test_parameters_and_other_columns(spark):
    docs = spark.createDataFrame([(i, "abc" * 5, "x", 1) for i in range(200)], "doc_id bigint, text string, form string, n int")
    signs = infill.Sentinels("[p]", "{s}", "(m)")
    made = infill.fill_in_middle(docs, signs, moved=100, suffix_first=100, seed=9)
    assert made.columns == ["doc_id", "text_h", "n", "form", "prefix_units", "middle_units", "output"]
    rows = made.select("*", infill.restored(F.col("form"), F.col("output"), signs).alias("text")).collect()
    assert {r.form for r in rows} == {"spm"} and {r.text for r in rows} == {"abc" * 5}
    assert len({r.output for r in rows}) > 50
    plain = infill.fill_in_middle(docs, moved=0).collect()
    assert {r.form for r in plain} == {"plain"} and {r.output for r in plain} == {"abc" * 5}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert infill.fill_in_middle(docs).collect() == []


@pytest.mark.parametrize("marks", [("", "<S>", "<M>"), ("<P>", "<P>x", "<M>"), ("ab", "ca", "d"), ("aa", "b", "c")])
def test_refuses_ambiguous_sentinels(marks):
    with pytest.raises(ValueError):
        infill.Sentinels(*marks)


def test_refuses_unknown_unit():
    (part,) = text_slices(pa.array(["a"]))
    with pytest.raises(ValueError):
        infill.Units(part, "word")
