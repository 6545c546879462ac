import random
import zlib
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dosewise.llm import toxicity as tox
from dosewise.llm.batches import text_slices

WORDS = ["rain", "falls", "over", "quiet", "fields", "and", "hills", "again", "softly", "häuser", "the"]


def prose(rng, *extra):
    words = [*rng.choices(WORDS, k=rng.randint(5, 40)), *extra]
    rng.shuffle(words)
    return " ".join(words)


def pairs(n, seed):
    """Toxic only if an insult meets a group: either alone is harmless, so no sum of the two
    weights can say so for certain."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = i % 4
        extra = [[], ["vermin"], ["villagers"], ["vermin", "villagers"]][kind]
        rows.append((i, prose(rng, *extra), int(kind == 3)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")


def test_learns_pairs_and_holds_out(spark):
    rows = pairs(800, 1)
    docs, labels = frames(spark, rows)
    model = tox.train(docs, labels)
    got = {r.doc_id: r for r in tox.score(docs, model).collect()}
    for i, _, y in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == int(got[i].score >= 0.5) and 0 <= got[i].score <= 1
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(held) > 100 and sum(p == y for p, y in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_read(spark):
    rows = pairs(200, 2)
    docs, labels = frames(spark, rows)
    flipped = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = tox.train(docs, labels), tox.train(docs.repartition(5), flipped.repartition(3))
    assert one.bias == other.bias and np.array_equal(one.weights, other.weights) and np.array_equal(one.factors, other.factors)


def test_stems_reach_unseen_words(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, *([f"lowei{chr(97 + i % 13)}x"] if i % 2 else [])), i % 2) for i in range(300)]
    docs, labels = frames(spark, rows)
    model = tox.train(docs, labels)
    unseen = spark.createDataFrame([(1, prose(rng, "loweizz")), (2, prose(rng))], "doc_id bigint, text string")
    got = {r.doc_id: r.predicted for r in tox.score(unseen, model).collect()}
    assert got == {1: 1, 2: 0}


def test_machine_against_all_pairs():
    rng = np.random.default_rng(4)
    weights, factors = rng.normal(size=20), rng.normal(size=(20, 3))
    sets = [[1, 5, 7], [], [2], [0, 1, 2, 3, 19]]
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - np.array([len(s) for s in sets])
    got, _ = tox.machine(np.concatenate(sets).astype(int), starts, ends, weights, factors)
    for value, s in zip(got, sets):
        assert value == pytest.approx(sum(weights[i] for i in s) + sum(factors[i] @ factors[j] for i, j in combinations(s, 2)))


def test_terms_are_whole_words_and_first_letters():
    texts = ["Idiot", "idiots", "x idiot,", "", None, "averyveryverylongword", "averyvery---longword"]
    (part,) = text_slices(pa.array(texts, pa.string()))
    owner, bins = tox.terms(part)
    sets = [set(bins[owner == i].tolist()) for i in range(len(texts))]
    assert len(sets[0]) == 3 and sets[0] < sets[2] and len(sets[0] & sets[1]) == 2
    assert sets[3] == sets[4] == set() and len(sets[5]) == 4
    alone = [set(tox.terms(p)[1].tolist()) for t in texts for p in text_slices(pa.array([t], pa.string()))]
    assert alone == sets


def test_sample_is_bounded(spark):
    docs, labels = frames(spark, pairs(200, 5))
    rows, sizes = tox.training_sample(docs.union(docs), labels.union(labels), "toxic", 2, 5)
    assert len(rows) <= 20 and sum(sizes.values()) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(200))


def test_edges(spark):
    docs, labels = frames(spark, pairs(100, 6))
    model = tox.train(docs, labels)
    rows = [(None, None, 1.0), (1, "", 2.0), (1, "", 2.0), (2, "vermin villagers " * 30000, 3.0)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    got = tox.score(odd, model).collect()
    assert len(got) == 4 and got[0].held_out and got[0].score == got[1].score == got[2].score
    assert tox.score(odd.limit(0), model).count() == 0
    # Nothing, or one label only, to learn from.
    assert [r.score for r in tox.score(odd, tox.train(docs, labels.limit(0))).collect()] == [0.5] * 4
    assert all(r.score > 0.99 for r in tox.score(odd, tox.train(docs, labels.where("toxic = 1"))).collect())
    assert tox.fit([SimpleNamespace(label=0, bins=b"")], {0: 1}).bias < -50


def test_fit_against_numeric_gradients(monkeypatch):
    """Three steps, with the likelihood written out document by document."""
    monkeypatch.setattr(tox, "LEAST_DOCS", 1)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(16):
        bins = np.unique(rng.integers(0, 6, rng.integers(1, 6)))
        label = int(0 in bins and 1 in bins) if i != 7 else 1
        rows.append(SimpleNamespace(label=label, bins=bins.astype("<i4").tobytes()))
    sizes = {0: 40, 1: 9}
    rounds, ridge, factors = 3, tox.RIDGE, 2
    model = tox.fit(rows, sizes, rounds, ridge, factors)
    ordered = sorted(rows, key=lambda r: (r.label, bytes(r.bins)))
    docs = [(r.label, [int(model.slots[b]) for b in np.frombuffer(r.bins, "<i4") if model.slots[b] >= 0]) for r in ordered]
    sampled = [sum(y == k for y, _ in docs) for k in (0, 1)]
    weight = np.array([sizes[y] / sampled[y] for y, _ in docs])
    weight /= weight.sum()
    n = tox.TERMS

    def gain(x):
        w, v = x[1 : n + 1], x[n + 1 :].reshape(n, factors)
        total = 0.0
        for share, (y, own) in zip(weight, docs):
            eta = x[0] + sum(w[t] for t in own) + sum(float(v[a] @ v[b]) for a, b in combinations(own, 2))
            total += share * (y * eta - np.log1p(np.exp(eta)))
        return total - ridge / 2 * ((w**2).sum() + (v**2).sum())

    prior = sum(share * y for share, (y, _) in zip(weight, docs))
    x = np.concatenate([[np.log(prior / (1 - prior))], np.zeros(n), np.random.default_rng(0).normal(0, tox.START, n * factors)])
    used = sorted({t for _, own in docs for t in own})
    moving = [0, *(1 + t for t in used), *(n + 1 + factors * t + f for t in used for f in range(factors))]
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        gradient = np.zeros_like(x)
        for i in moving:
            up, down = x.copy(), x.copy()
            up[i], down[i] = x[i] + 1e-5, x[i] - 1e-5
            gradient[i] = (gain(up) - gain(down)) / 2e-5
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        x = x + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    assert model.bias == pytest.approx(x[0], abs=1e-4)
    assert np.allclose(model.weights[used], x[1 : n + 1][used], atol=1e-3)
    assert np.allclose(model.factors[used], x[n + 1 :].reshape(n, factors)[used], atol=1e-3)


def test_sample_of_very_long_texts_is_bounded_in_bytes(spark):
    rng = random.Random(4)
    long = " ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(30_000))
    docs = spark.createDataFrame([(i, long if i % 2 else "a few words") for i in range(1, 9)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id bigint, toxic int")
    rows, _ = tox.training_sample(docs, labels, "toxic")
    assert {len(r.bins) for r in rows if r.label == 1} == {4 * tox.PER_TEXT}
