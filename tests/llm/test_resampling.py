import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dosewise.llm import resampling
from dosewise.llm.batches import text_slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = [f"{a}{b}" for a in ("sun", "Moon", "zürich", "中", "x9") for b in ("", "ly", "ER", "!ing", "-", "é")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def buckets(text, longest, bins):
    words = WORD.findall(lower(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % bins for r in runs]


def expected(docs, target, percent, least_words, longest, bins, seed=2024):
    own = [buckets(t, longest, bins) for _, t in docs]
    s = Counter(b for _, found in own for b in found)
    t = Counter(b for text in target for b in buckets(text, longest, bins)[1])
    n_s, n_t = sum(s.values()) + bins, sum(t.values()) + bins
    rows = []
    for (doc_id, _), (n_words, found) in zip(docs, own):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in found)
        digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = int(digest[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, n_words, len(found), weight, score])
    fit = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        ranks.setdefault((r[0], r[4]), []).append(rank)
    return rows, ranks


def check(spark, docs, target, percent=30, least_words=3, longest=1, bins=50, **more):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, score string, rank int")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(frame, aim, percent, least_words, longest, bins, **more)
    assert found.columns == ["doc_id", "text_h", "n_words", "n_features", "weight", "score", "rank"]
    rows, ranks = expected(docs, target, percent, least_words, longest, bins)
    got = found.collect()
    assert sorted(map(str, [[r.doc_id, r.n_words, r.n_features, r.weight, r.score] for r in got])) == sorted(map(str, rows))
    drawn = {}
    for r in got:
        if r["rank"] is not None:
            drawn.setdefault((r.doc_id, r.score), []).append(r["rank"])
    assert {k: sorted(v) for k, v in drawn.items()} == ranks
    return got


def prose(rng, n):
    return rng.choice([" ", ", ", "\n"]).join(rng.choices(VOCABULARY, k=n))


@pytest.mark.parametrize("longest", [1, 3])
def test_against_brute_force(spark, longest):
    rng = random.Random(longest)
    docs = [(i, prose(rng, rng.randint(0, 30))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "…"), (303, "a" * 3000 + " b " * 5000), (-5, "below zero it is"), (None, "three words here")]
    check(spark, docs, [prose(rng, 12) for _ in range(20)] + [None, ""], longest=longest, sections=3, range_rows=20)


def test_ties_and_repeated_rows(spark):
    """One id, one score, a third of all rows: as many are drawn as are due."""
    same = [(7, "the very same words"), (8, "the very same words")]
    docs = [*same * 40, *[(i, f"word{i % 5} and some more") for i in range(100, 200)]]
    got = check(spark, docs, ["the very same words"], percent=35)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(docs) * 35 // 100 + 1))
    nobody = [(None, f"no id here {i % 3}") for i in range(60)]
    check(spark, nobody, ["no id here"], percent=50)


def test_ties_go_to_the_smaller_id(spark):
    scores = spark.createDataFrame(
        [(i, 5) for i in (9, 3, 7, 1, None)] + [(i, 8) for i in (20, 21)] + [(4, 1)], "doc_id bigint, score bigint")
    assert [resampling.cutoff(scores, n, sections=2) for n in range(1, 9)] == [
        (8, 20), (8, 21), (5, 1), (5, 3), (5, 7), (5, 9), (5, None), (1, 4)]


def test_extremes_of_the_range():
    values = sorted([-(2**62), -5, -5, 0, 7, 2**62])
    for wanted in range(1, 7):
        for sections in (2, 5, 32):
            found = resampling._bisected(
                values[0], values[-1], wanted, lambda at: [sum(v <= a for v in values) for a in at], sections)
            assert found == values[wanted - 1]


def test_nothing_to_draw(spark):
    check(spark, [(1, "too short"), (2, None)], ["some target"])
    check(spark, [(1, "one document of five words")], [], percent=50)  # half of one is none
    check(spark, [], ["some target"])


def test_everything_drawn(spark):
    check(spark, [(i, "just three words") for i in range(12)], [], percent=100, range_rows=5)


def test_checksums_of_long_and_short_words():
    words = ["a", "é" * 20, "b" * 64, "c" * 65, "d" * 1000, "zz"]
    (part,) = text_slices(pa.array([" ".join(words), "", "last"]))
    n_words, owner, bucket = resampling.features(part, 2, 997)
    assert n_words.tolist() == [6, 0, 1] and np.bincount(owner).tolist() == [11, 0, 1]
    runs = words + [" ".join(p) for p in zip(words, words[1:])] + ["last"]
    assert sorted(bucket.tolist()) == sorted(zlib.crc32(r.encode()) % 997 for r in runs)
