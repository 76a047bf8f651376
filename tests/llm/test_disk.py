"""What stays on disk between the writes of an operator."""

import os
import random

import brute
import pytest
from pyspark.sql import functions as F

from landfall.llm import jaccard
from landfall.llm.common import drop_written, written
from landfall.session import freed_shuffles, shared_dir

CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled(spark):
    """Shuffle files that the session holds."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def tables(spark):
    top = f"{shared_dir(spark).removeprefix('file:')}/landfall"
    return {f for f in os.listdir(top) if f.startswith("llm-")} if os.path.isdir(top) else set()


def edited(rng, words, share):
    return [f"n{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


def test_a_written_table_leaves_no_shuffle(spark):
    before = shuffled(spark)
    out = written(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count(), "test-shuffle")
    assert not shuffled(spark) - before
    assert sorted(r["count"] for r in out.collect()) == [100] * 10


def test_freed_shuffles_restores_the_setting(spark):
    before = spark.conf.get(CONF, None)
    with pytest.raises(ValueError):
        with freed_shuffles(spark):
            assert spark.conf.get(CONF) == "true"
            raise ValueError
    assert spark.conf.get(CONF, None) == before


def test_drop_written_takes_intermediate_tables_only(spark, scratch):
    out, other = written(spark.range(5), "test-drop"), written(spark.range(3), "test-drop")
    drop_written(out)
    assert not os.path.exists(os.path.dirname(out.inputFiles()[0].removeprefix("file:"))) and other.count() == 3
    spark.range(5).write.parquet(scratch)
    mine = spark.read.parquet(scratch)
    with pytest.raises(ValueError):
        drop_written(mine)
    assert mine.count() == 5


def test_near_duplicates_leave_no_texts_and_blocks_meet_in_rounds(spark, monkeypatch):
    """Families of many blocks, whose pairs are compared some at a time: all links are found, no copy of the texts stays."""
    rng = random.Random(9)
    texts = {}
    base = [f"b{rng.randrange(10**9)}" for _ in range(60)]
    for _ in range(6):
        base = edited(rng, base, 0.02)  # a chain: the first and the last do not link
        for _ in range(8):
            texts[len(texts)] = " ".join(edited(rng, base, rng.choice([0, 0.01, 0.03])))
    calls, whole, links = [], jaccard.verified, jaccard.links
    monkeypatch.setattr(jaccard, "GROUP", 5)
    monkeypatch.setattr(jaccard, "ROUND", 1)
    monkeypatch.setattr(jaccard, "verified", lambda *a: calls.append(1) or whole(*a))
    monkeypatch.setattr(jaccard, "links", lambda *a: links(*a, pivots=1))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    before = tables(spark)
    found = jaccard.join(rows)
    new = tables(spark) - before
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute.jaccard(texts)
    assert len(calls) > 4  # two of whole components, one of pivots, the rounds
    assert new and not [t for t in new if t.startswith("llm-jaccard-texts")]
