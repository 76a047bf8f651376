"""Whole texts, many matches, repeated ids and clashing columns."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from landfall.llm import langid, linededup, mixing, secrets, toxicity


def phrases(text: bytes, sample: bytes) -> int:
    n, at = 0, 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at:at + k + 1] in sample:
            k += 1
        n, at = n + 1, at + k
    return n


def test_phrases_of_long_texts():
    """Counts equal those of one walk, also where a phrase spans lanes and no two walks ever meet."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(60)]
    sample, other = " ".join(rng.choices(words, k=300)).encode(), b"a" * 700 + b"xyz"
    texts = [" ".join(rng.choices(words, k=18_000)).encode(), sample, b"a" * 5000, b"", b"q" * 1500, other * 3, sample[:513], b"h"]
    got = langid.CrossParser({"a": sample, "b": other}).phrases(texts)
    assert len(texts[0]) > 100_000
    assert got.tolist() == [[phrases(t, sample), phrases(t, other)] for t in texts]
    assert got[1, 0] == 1  # over 1,000 bytes, one phrase


def test_language_samples_lie_all_over_the_text(spark):
    head = "common opening " * 2000
    rows = [(i, head + "".join(chr(0x430 + (i + j) % 30) for j in range(40_000)), "xx") for i in range(60)]
    rows += [(1000 + i, "123 ½ --", "yy") for i in range(400)] + [(5000 + i, "late letters", "yy") for i in range(3)]
    rows += [(7, "other text of an id", "xx"), (9000, None, "zz"), (None, "text", "ww"), (9001, "text", None)]
    got = langid.samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(got) == {"xx", "yy"} and b"late letters" in got["yy"]  # rows without a letter take no place
    assert "а".encode() in got["xx"] and len(got["xx"]) <= langid.TEXTS * (langid.TEXT_BYTES + 2)
    assert got == langid.samples(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string"))
    empty = langid.predict(spark.createDataFrame([(1, "½ ² 12"), (2, "é")], "doc_id long, text string"), got).collect()
    assert [r["lang_pred"] == "und" for r in sorted(empty)] == [True, False]


def test_secrets_of_many_matches(spark):
    rng = random.Random(4)
    hexes = " ".join("".join(rng.choices("0123456789abcdef", k=30)) for _ in range(3000))
    token = "Zq9" * 9
    mixed = " ".join(f"é{i} password: hunter{i:04d} {token}{i:05d} AKIA{i:016d}" for i in range(700))
    rows = [(1, hexes, "s"), (2, mixed, "s"), (3, f"token={token} {token}x", "s")]
    got = {r["doc_id"]: r for r in secrets.report(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    names = ("assign", "access", "hex")
    for i, text, _ in rows:
        want = [f"{names[k]}:{s}:{e}" for s, k, e in brute.secrets(text)]
        assert got[i]["base_sha256"] == brute.sha(",".join(want))
        assert set(want) <= set(got[i]["spans"].split(","))
    tokens = [x for x in got[2]["spans"].split(",") if x.startswith("token")]
    at = [mixed.index(f"{token}{i:05d}") for i in range(700)]
    assert tokens == [f"token:{s}:{s + len(token) + 5}" for s in at]
    assert [x for x in got[3]["spans"].split(",") if x.startswith("token")] == [f"token:{len(token) + 7}:{2 * len(token) + 8}"]


def test_lines_of_repeated_ids(spark):
    """Rows that share an id are one document; a null id is one by itself."""
    a, b = ("A line held by few ids in many rows, and long enough.", "A line held by five ids, in rows that are long enough.")
    rows = [(1, a), (1, a), (1, a + "\n" + b), (2, a), (2, a)] + [(i, b + "\nown") for i in range(2, 6)]
    got = linededup.LineIndex(d := spark.createDataFrame(rows, "doc_id long, text string")).report(d).collect()
    want = [(1, 1, 0), (1, 1, 0), (1, 2, 1), (2, 1, 0), (2, 1, 0), (2, 2, 1), (3, 2, 1), (4, 2, 1), (5, 2, 0)]
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in got) == want
    nulls = spark.createDataFrame([(None, a)] * 5, "doc_id long, text string")
    assert linededup.surplus(nulls) is None
    assert [r["n_dropped"] for r in linededup.LineIndex(nulls).report(nulls).collect()] == [0] * 5


def test_keys_equal_in_one_half():
    lo = np.array([5, 5, 5, 9], np.uint64)
    hi = np.array([1, 2, 3, 1], np.uint64)
    s = linededup.Shard(hi, lo, np.full(4, 5), np.arange(4))
    ok, keeper = s.probe(hi, lo)
    assert ok.all() and keeper.tolist() == [0, 1, 2, 3]
    assert not s.probe(np.array([7], np.uint64), np.array([5], np.uint64))[0].any()


def test_mix_keeps_clashing_columns(spark):
    rows = [(i, "w " * (i % 7 + 1), "ab"[i % 2], 1, 2, 3, 4, 5, 6) for i in range(60)]
    names = ["doc_id", "text", "source", "_place", "_source", "Times", "mix_times", "_last0", "row"]
    out = mixing.mixed(spark.createDataFrame(rows, names))
    assert out.columns == [*names, "mix_mix_times"]
    got = out.collect()
    assert got and all(tuple(r)[3:9] == (1, 2, 3, 4, 5, 6) and r["mix_mix_times"] >= 1 for r in got)
    plain = mixing.mixed(spark.createDataFrame(rows, names).select("doc_id", "text", "source"))
    assert sorted((r["doc_id"], r["times"]) for r in plain.collect()) == sorted((r["doc_id"], r["mix_mix_times"]) for r in got)


def test_labelled_sample_takes_an_id_once(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    hot = spark.range(500).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    got = toxicity.labelled_sample(docs.unionByName(hot), labels, limit=30).collect()
    taught = [i for i in range(40) if brute.crc(i, 5)]
    assert len(got) == min(30, len(taught))
    assert sum(r["text"] != "some text" for r in got) == 0
