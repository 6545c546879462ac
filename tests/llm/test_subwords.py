import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from dosewise.llm import subwords
from dosewise.llm.batches import text_slices

SIGNS = [
    "a", "b", "e", "r", "▁", " ", "  ", "    ", "\n", "\t", "\r\n", "é", "é", "ﬁ", "①", "中", "的", "🙂", "\x00",
    "</s>", "<unk>", "<0x41>", "the", "ing", "yout", "pause", "!=", "====", "____", "0", "{", "();", "ssss", "한국", "�",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def texts(library):
    rng = random.Random(1)
    words = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    found = ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(4000)]
    found += ["".join(rng.choices("aab", k=rng.randint(0, 60))) for _ in range(1000)]
    found += ["".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(4000)]
    found += [rng.choice(words) * rng.randint(2, 5) for _ in range(4000)]  # overlapping and repeated pairs
    found += [sign * n for sign in " a=-▁\n" for n in range(0, 150, 7)]
    return [*found, "", None]


def encode_all(texts_):
    model = subwords.load()
    ids, decoded = [], []
    for part in text_slices(pa.array(texts_, pa.string()), 1 << 16):
        flat, counts = subwords.encode(model, part.data, part.starts, part.ends)
        ids += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
        decoded += subwords.decode(model, flat.astype(np.int64), counts)
    return ids, [d.decode() for d in decoded]


def test_against_the_library(library):
    given = texts(library)
    ids, decoded = encode_all(given)
    assert ids == library.encode([t or "" for t in given], add_bos=True, add_eos=True)
    assert decoded == [library.decode(x) for x in ids]


@pytest.mark.parametrize("text", [" " * 100_000, "x" * 100_000, "aB3" * 50_000, "中的" * 20_000, "\x00" * 20_000])
def test_very_long_words(library, text):
    ids, decoded = encode_all([text, "after"])
    assert ids == library.encode([text, "after"], add_bos=True, add_eos=True)
    assert decoded == [text, "after"]


def test_merges_in_turn_and_in_rounds_agree():
    model = subwords.load()
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices(["a", "b", "s", "t", "e", " "], k=rng.randint(1, 40)))
        own = model.of_code[[ord(c) for c in text]]
        rounds, n = subwords.merged(model, own.copy(), np.array([0]))
        assert rounds.tolist() == subwords._in_turn(model, own).tolist() and n.tolist() == [len(rounds)]


def test_decodes_any_list(library):
    rng = random.Random(3)
    bytes_and_more = [0, 1, 2, 3, 29, 130, 200, 227, 162, 133, 132, 243, 259, 260, 28705, 1000, 5000]
    lists = [rng.choices(bytes_and_more, k=rng.randint(0, 12)) for _ in range(4000)]
    flat = np.array([x for one in lists for x in one], np.int64)
    found = subwords.decode(subwords.load(), flat, np.array([len(x) for x in lists]))
    assert [d.decode() for d in found] == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        subwords.decode(subwords.load(), np.array([32000]), np.array([1]))


def test_digest_that_collides(monkeypatch, library):
    """Words are told apart by their symbols even if all digests are alike."""
    monkeypatch.setattr(subwords, "MIX", np.uint64(0))
    model = subwords.load()
    (part,) = text_slices(pa.array(["one two three one", "two"]))
    monkeypatch.setattr(subwords.PairTable, "get", lambda self, a, b: np.array(
        [int(self.values[np.flatnonzero(self.keys == (int(x) << 21 | int(y)))[0]]) if (self.keys == (int(x) << 21 | int(y))).any()
         else subwords.NONE for x, y in zip(a, b)], np.int32))
    flat, counts = subwords.encode(model, part.data, part.starts, part.ends)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == library.encode(
        ["one two three one", "two"], add_bos=True, add_eos=True)


def test_frames(spark, library):
    rows = [(1, "One text.", "x"), (1, "One text.", "y"), (None, "no id", "x"), (2, None, "x"), (3, "", "x"), (4, "🙂 ▁", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    wanted = sorted((str(i), library.encode(t or "", add_bos=True, add_eos=True)) for i, t, _ in rows)
    plain = subwords.encoded(docs)
    assert plain.columns == ["doc_id", "text_h", "ids"]
    assert sorted((str(r.doc_id), r.ids) for r in plain.collect()) == wanted
    packed = subwords.encoded(docs, packed=True)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in packed.collect()) == wanted
    for made in (plain, packed):
        back = subwords.decoded(made.withColumn("text", F.lit("old"))).collect()
        assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), (t or "").replace("▁", " ")) for i, t, _ in rows)
    nothing = plain.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {r.text for r in subwords.decoded(nothing).collect()} == {""}
    assert subwords.decoded(subwords.encoded(docs.limit(0))).collect() == []


def test_refuses_other_models():
    path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        blob = file.read()
    for extra in (b"\x12\x02\x18\x01", b"\x1a\x02\x20\x01", b"\x1a\x03\x12\x01x"):  # unigram, spaces squeezed, own rules
        with pytest.raises(ValueError):
            subwords.parse(blob + extra)
