import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dosewise.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")


def ids_of(text):
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reader.encode_special_tokens = True
    return [*reader.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def sample(seed):
    rng = random.Random(seed)
    words = ["alpha", "béta", " x", "12", "…", "\n\n", "'s", "日本", "🙂"]
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 3, 30, 200, 900]))) for i in range(60)}
    return texts | {100: None, 101: "", 102: "x<|endoftext|>y", 103: "a" * 50000, 104: texts[3], 105: texts[3]}


@pytest.mark.parametrize("capacity, share_rows", [(1024, 1 << 14), (64, 7)])
def test_round_trip(spark, capacity, share_rows):
    texts = sample(1)
    rows = packing.pack(frame(spark, texts), capacity=capacity, share_rows=share_rows).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = ids_of(text)
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert all(r.length == capacity for r in pieces[1:]) and sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for places in by_sequence.values():
        places.sort()
        assert [p[0] for p in places] == [0, *np.cumsum([p[1] for p in places])[:-1]]
        assert sum(p[1] for p in places) <= capacity


def test_sequences_hold_the_tokens(spark):
    texts = sample(2)
    docs = frame(spark, texts)
    got = Counter(t for r in packing.sequences(docs.union(docs.limit(5)), capacity=128).collect() for t in r.ids)
    expected = Counter(t for r in docs.union(docs.limit(5)).collect() for t in ids_of(r.text))
    assert got == expected


def test_plan_covers_every_rank_once_and_packs_tightly():
    rng = np.random.default_rng(3)
    for scale in (1, 50):
        histogram = {int(k): int(n) * scale for k, n in enumerate(rng.integers(0, 9, 257)) if k and n}
        made = packing.plan(histogram, 256)
        seen, filled = Counter(), Counter()
        for k, n in histogram.items():
            length, rank = np.full(n, k), np.arange(n)
            run = np.searchsorted(made.keys, (length << packing.RANK_BITS) + rank, "right") - 1
            assert (made.keys[run] >> packing.RANK_BITS == k).all()
            for s, o in zip(made.sequences[run] + rank - made.ranks[run], made.offsets[run]):
                seen[int(s), int(o)] += 1
                filled[int(s)] += k
        assert max(seen.values()) == 1 and max(filled.values()) <= 256
        least = max(-(-sum(k * n for k, n in histogram.items()) // 256), sum(n for k, n in histogram.items() if k > 128))
        assert len(filled) == made.n_sequences <= 1.025 * least + 1
    assert len(made.keys) < 5000  # whatever the number of pieces


def test_plan_against_the_best_possible():
    # Three kinds that fill a sequence only together.
    made = packing.plan({50: 40, 30: 40, 20: 40}, 100)
    assert made.n_sequences == 40
    assert packing.plan({}, 100).n_sequences == 0
    assert packing.plan({100: 7, 1: 3}, 100).n_sequences == 8


def documents_like(n, seed):
    """Lengths as of prose: most documents short, many last pieces of any length."""
    rng = np.random.default_rng(seed)
    lengths = np.where(rng.random(n) < 0.5, rng.integers(1, 1024, n), np.minimum(rng.lognormal(5, 1, n), 1023))
    return {int(k): int(c) for k, c in zip(*np.unique(np.maximum(lengths, 1).astype(int), return_counts=True))}


@pytest.mark.parametrize("n", [5_000, 500_000])
def test_program_converges_and_packs_nearly_all(n):
    histogram = documents_like(n, 1)
    made = packing.plan({**histogram, 1024: 77}, 1024)
    assert made.n_full == 77
    assert made.value <= made.bound * (1 + packing.GAP)
    least = sum(k * c for k, c in histogram.items()) / 1024
    assert made.bound >= 0.99 * least and made.n_program + made.n_rest <= 1.01 * least + 2
    assert made.n_rest <= 0.05 * made.n_sequences


def test_bound_holds_where_tokens_say_little():
    """Only ten of a thousand can be filled up: the bound must see it, not count tokens."""
    solution = packing.configurations({700: 1000, 300: 10}, 1024)
    assert 990 <= solution.bound <= 1000 + 1e-6 and solution.value == pytest.approx(1000, rel=1e-3)
    made = packing.plan({700: 1000, 300: 10}, 1024)
    assert made.n_sequences == 1000


def test_solution_covers_and_rounding_takes_what_is_there():
    histogram = documents_like(3_000, 2)
    solution = packing.configurations(histogram, 1024)
    covered = Counter()
    for members, use in solution.uses.items():
        assert sum(k * n for k, n in members) <= 1024
        for k, n in members:
            covered[k] += n * use
    assert all(covered[k] == pytest.approx(n, rel=1e-4) for k, n in histogram.items())
    left = dict(histogram)
    taken = packing.rounded(solution, left, 1024)
    assert min(left.values()) >= 0
    for k, n in histogram.items():
        assert left[k] + sum(times * dict(members).get(k, 0) for members, times in taken) == n


def test_best_fit_alone():
    groups = packing.best_fit({6: 3, 4: 2, 3: 1, 1: 9}, 10)
    assert sum(n for _, n in groups) == 4
    total = Counter()
    for members, n in groups:
        assert sum(members) <= 10
        for k in members:
            total[k] += n
    assert total == {6: 3, 4: 2, 3: 1, 1: 9}


def test_empty_repeats_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(None, "a b", 1), (1, "a b", 2), (1, "a b", 2), (1, None, 3)], "doc_id bigint, text string, length int"
    )
    assert packing.pack(docs).count() == 4
    assert packing.pack(docs.limit(0)).count() == 0


def test_one_document_repeated_many_times(spark):
    """All rows alike: shares of a length are dealt by the pieces' numbers."""
    docs = spark.range(400).selectExpr("cast(null as bigint) as doc_id", "'the same text' as text")
    rows = packing.pack(docs, capacity=64, share_rows=16).collect()
    assert len(rows) == 400 and len({(r.sequence_id, r.offset) for r in rows}) == 400
    plan = packing.pack(docs, capacity=64, share_rows=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(number" in plan


def test_special_strings_on_request(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id bigint, text string")
    ids = packing.pieces(docs, with_ids=True, special={"<|endoftext|>": 50256}).first().ids
    assert ids == [64, 220, 50256, 275, packing.END_ID]
    assert packing.pieces(docs, with_ids=True).first().ids == ids_of("a <|endoftext|> b")


def test_runs_of_white_space_longer_than_the_pattern_can_take(spark):
    n = 1_500_000
    texts = {0: " " * n, 1: "a b" + " " * n + "word", 2: "x" + "\n" * n + "y", 3: "é\n" + " \n" * (n // 2) + "\n…",
             4: "　" * 60000 + "a" + " " * n + "\x1c" + "\n" * n + "'s", 5: "a" * n + "1" * n + "!" * n + " " * n}
    rows = packing.pieces(frame(spark, texts), capacity=1 << 23).collect()
    expected = {i: ids_of(t) for i, t in texts.items()}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in expected.items()
    }
