"""Tree concatenation against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from groupledger.llm import bpe

FILE = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def model():
    return bpe.read_model(FILE)


def _long_words(seed: int) -> list[str]:
    """Unsplit texts over many leaves: few letters, words run together, other scripts."""
    rng = random.Random(seed)
    syllables = "ing the er ation con tra pre est ly un der over wh str ough ph qu xz".split()
    alphabets = ["a", "ab", "aab", "abcdefghijklmnopqrstuvwxyz", syllables, "éèñüß", "字漢語一", "😀🎉"]
    words = []
    for letters in alphabets:
        for size in (63, 64, 65, 129, 500, 3000):
            words.append("".join(rng.choice(letters) for _ in range(size)))
    return [*words, "=" * 1000, "-" * 777, "1" * 500, "0123456789" * 90, "internationalization" * 60]


def test_long_words_join_exactly(model, library):
    words = [w for seed in range(3) for w in _long_words(seed)]
    for word, got in zip(words, bpe.encode_words(model, [w.encode() for w in words]), strict=True):
        assert got.tolist() == library.encode(word, add_special_tokens=False).ids, word[:40]


def test_windows_grow_until_both_sides_agree(model, library, monkeypatch):
    """Halves of a run of one letter are cut out of step, so no small window agrees."""
    sizes = []
    plain = bpe.merge_all
    monkeypatch.setattr(
        bpe, "merge_all", lambda m, ids, lengths: (sizes.append(len(ids)), plain(m, ids, lengths))[1]
    )
    a, b = (bpe.encode_words(model, [b"=" * n])[0] for n in (61, 64 * 20))
    sizes.clear()
    joined = bpe.join_all(model, [(a, b)])[0]
    assert len(sizes) > 1 and sizes == sorted(sizes)
    assert joined.tolist() == library.encode("=" * (61 + 64 * 20), add_special_tokens=False).ids


def test_texts_against_the_library(spark, library):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t\x0b", "\x85\xa0", "　", "don't", "'LL", "we've", "x", "Hello", "123", "½²", "<|endoftext|>",
             "<|", "é", "é", "😀", "ࡰ", "\U00031350", "!!", "_", "\x00", "\x1c", "​", "ﬁ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", "a" * 200_000, " " * 100_000, "x y " * 50_000, "word" * 30_000 + "<|endoftext|>" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = bpe.encode(df, FILE, back=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False) == texts[r.doc_id]


def test_decoding_of_cut_characters(spark, library):
    """Ids that end within a character decode to the replacement character, as in the library."""
    ids = library.encode("a😀漢é字", add_special_tokens=False).ids
    cuts = [ids[a:b] for a in range(len(ids)) for b in range(a, len(ids) + 1)] + [None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cuts)], "n long, ids array<int>")
    for r in bpe.decode(df, FILE).collect():
        assert r.decoded == library.decode(cuts[r.n] or [], skip_special_tokens=False)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, " \n "), (3, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("ids", "words", "odd", "decoded"):
        df = df.withColumn(name, F.lit(7))
    got = sorted((str(r.doc_id), r.decoded, len(r.ids)) for r in bpe.encode(df, FILE, back=True).collect())
    assert got == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("3", " \n ", 3), ("3", " \n ", 3), ("None", "a b", 2)]
    assert bpe.encode(df.limit(0), FILE).count() == 0


def test_memory_of_words_is_bounded(model, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "KNOWN", 50)
    encoder, words = bpe.Encoder(model), [f"w{i}" for i in range(40)]
    first, _ = encoder.encoded(pa.array([words]))
    encoder.encoded(pa.array([[f"v{i}" for i in range(40)]]))
    again, edges = encoder.encoded(pa.array([words, []]))
    assert len(encoder.slots) <= 50
    assert np.array_equal(first, again)
    assert edges.tolist() == [0, len(first), len(first)]


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = bpe.op11_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
