"""Operator 11 against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.conftest import SF001
from landfall.llm import bpe
from landfall.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def engine():
    return bpe.Engine(bpe.vocabulary(PATH, public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_documents(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF001, "documents").collect()}
    got = bpe.op11(spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), digest(ids))
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, library):
    """Null, empty, repeated and long texts, null ids, columns of the result's names."""
    long = " ".join(random.Random(1).choice(["alpha", "Ünï", "漢字", "12345", "it's"]) for _ in range(20_000))
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, long), (None, "x\x00y"), (5, " \n\n \t"), (6, "<|endoftext|>")]
    df = spark.createDataFrame([(i, t, -1, "x") for i, t in rows], "doc_id long, text string, ids int, decoded string")
    coder = bpe.ByteBpe(spark, PATH, public_tokenizers.PATTERN)
    got = coder.decode(coder.encode(df, "doc_id"), "doc_id").collect()
    want = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r[0], bytes(r[1]), bytes(r[2])) for r in got], key=key) == sorted(want, key=key)
    none = df.where("false")
    assert coder.decode(coder.encode(none, "doc_id"), "doc_id").collect() == []


def test_every_code_point(engine, library):
    texts = ["".join(map(chr, range(i, i + 64))) for i in range(0, 0x110000, 64) if not 0xD800 <= i < 0xE000]
    assert [np.frombuffer(p, "<u4").tolist() for p in engine.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_made_words(engine, library):
    """Random letters, runs, scripts without blanks: many pairs of lower rank appear after a merge."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 70))) for _ in range(2000)]
    texts += ["a" * n for n in range(1, 150)] + [" " * n + "x" for n in range(40)] + ["=" * n for n in range(70)]
    texts += ["".join(chr(rng.choice([0x4E00, 0xAC00, 0x30A0, 0xE00]) + rng.randrange(80)) for _ in range(100)) for _ in range(100)]
    packed = engine.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert engine.decode(packed) == [t.encode() for t in texts]


def test_long_words(engine, library, monkeypatch):
    """Words of 100,000 bytes; and in queries of a few rounds, a few ids and a few words."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "thequickbrownfox" * 3000, "a" * 100_000,
             "".join(rng.choice("ABCXYZabcxyz") for _ in range(100_000))]
    assert [np.frombuffer(p, "<u4").tolist() for p in engine.encode(words)] == [library.encode_ordinary(w) for w in words]
    engine.forget()
    for name, value in {"HELD": 3000, "WORDS": 7, "REMEMBERED": 10, "IDS": 50, "SHORT_BYTES": 40, "LONG_BYTES": 90}.items():
        monkeypatch.setattr(bpe, name, value)
    text = "Some words, and " + words[0][:1500] + " then " + "word " * 30
    packed = engine.encode([text, "", text[:9]])
    assert np.frombuffer(packed[0], "<u4").tolist() == library.encode_ordinary(text)
    assert engine.decode(packed) == [text.encode(), b"", text[:9].encode()]


def test_other_vocabulary(library):
    """The merge table follows the file: pairs that only bytes have stay bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    one = bpe.Engine(bpe.vocabulary(path, public_tokenizers.PATTERN))
    own = tiktoken.Encoding("two", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    text = "Ein Satz über 12 Wörter; naïve façade — 漢字 https://example.org/abc?d=e"
    assert np.frombuffer(one.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)
