"""Mixing sources to target weights by weighted fair queueing (operator 5).

Every source is a queue of its documents in shuffled order, repeated once if
need be.  A document's virtual finish time is the running total of its
source's words, up to and with it, divided by the source's target; the mix is
all documents of all queues in order of finish time, cut where the words reach
the total budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from landfall.llm.common import table, written

WEIGHTS, SHARE, REPEATS = (3.0, 1.0, 2.0), 1.5, 2
#: Documents in one piece of a running total.
PIECE = 1024
BLANK = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    bare = F.btrim(text, F.lit(BLANK))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, 0).otherwise(
        F.size(F.split(bare, r"[ \t\n\x0B\f\r]+"))).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code-point order, null last, take the weights in turn; a target
    is weight * level, at most ``repeats`` times the source's size, with the
    level at which the targets make up ``share`` of all words.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))  # one row per source
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    cap = F.col("source_size") * float(repeats)
    # sources fill up in order of cap / weight; the level is set by those that do not
    fill = Window.orderBy("ratio", F.col("source").isNull(), "source")
    rows = (per.withColumn("weight", w).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("full", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * share)
            .withColumn("level", (F.col("budget") - F.col("full")) / F.col("open"))
            # the first level that leaves its own source open, after which they fall; none: all are full
            .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(Window.partitionBy())))
    return rows.select("source", "source_size",
                       F.when(F.col("level").isNull(), F.col("cap"))
                       .otherwise(F.least("cap", F.col("weight") * F.col("level"))).alias("target"))


def _running(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Column ``name``: running total of ``size`` per ``turn`` in ``order``, made piece by piece.

    The sums of the pieces are added up first, so that the rows of a large
    source never meet in one task.
    """
    sums = rows.groupBy("turn", "piece").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("turn").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select("turn", "piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")),
                     "mix-pieces")
    own = Window.partitionBy("turn", "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("_own", F.sum("size").over(own)).join(starts, ["turn", "piece"])
            .withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before"))


ORDER = ["shuffled", "key", "size"]


def queue(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, shuffled, key): a document's place in its source's queue.

    The shuffle is a hash of the id, so reruns agree; equal ids keep together
    in order of size.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                       F.xxhash64(F.col(doc_id).cast("string"), F.lit(5)).alias("shuffled"),
                       F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("key"))


@dataclass(frozen=True)
class Mix:
    """rows: every document with its source's target and its finish time; horizon: the time the budget lasts to."""

    rows: DataFrame
    sources: DataFrame
    horizon: float

    def taken(self) -> DataFrame:
        """rows with ``times``, how often the mix takes the document."""
        times = sum(((F.col("finish") + e * F.col("lap")) <= self.horizon).cast("int") for e in range(REPEATS))
        return self.rows.withColumn("times", F.coalesce(times, F.lit(0)))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE) -> Mix:
    """Fair queueing of all documents.

    finish = running total / target, lap = source_size / target, so the copy of
    round e ends at finish + e * lap.  Sources of no words have no target and
    are never taken; documents of no words ride along and take nothing.
    """
    rows = written(queue(docs, doc_id, text, source), "mix-queue")
    sources = written(targets(rows, weights, share), "mix-targets")
    n, budget = rows.count(), sources.agg(F.sum("target")).first()[0] or 0.0
    pieces = max(1, n // PIECE)
    piece = F.least(F.floor((F.col("shuffled") / F.lit(2.0 ** 64) + 0.5) * pieces), F.lit(pieces - 1))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    named = written(sources.withColumn("turn", F.row_number().over(order)), "mix-sources")
    rows = (rows.join(named.withColumnRenamed("source", "_source"), rows["source"].eqNullSafe(F.col("_source")))
            .drop("_source").withColumn("piece", piece))
    times = written(_running(rows, ORDER, "total")
                    .withColumn("finish", F.when(F.col("target") > 0, F.col("total") / F.col("target")))
                    .withColumn("lap", F.when(F.col("target") > 0, F.col("source_size") / F.col("target")))
                    .drop("total", "piece"), "mix-times")
    return Mix(times, named, _horizon(times, budget))


def _horizon(times: DataFrame, budget: float, ranges: int = 1024) -> float:
    """The last finish time before the words taken pass the budget.

    Copies are counted by ranges of finish time; the range where the budget
    ends is cut into ranges again, until it holds one time or few rows, which
    are then ordered.
    """
    copies = times.where((F.col("size") > 0) & (F.col("target") > 0)).select(
        F.explode(F.array(*[F.col("finish") + e * F.col("lap") for e in range(REPEATS)])).alias("at"), "size")
    low, high, taken = 0.0, copies.agg(F.max("at")).first()[0], 0
    if high is None:
        return float("inf")
    for _ in range(6):  # beyond, a range is narrower than a double's last digits
        width = (high - low) / ranges
        inside = copies.where((F.col("at") >= low) & (F.col("at") <= high))
        if width <= 0:
            break
        number = F.least(F.floor((F.col("at") - low) / width), F.lit(ranges - 1))
        sums = (inside.groupBy(number.alias("k")).agg(F.sum("size").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"),
                                                      F.count("*").alias("rows")).orderBy("k").collect())  # ``ranges`` rows at most
        for r in sums:
            if taken + r["n"] > budget + 1e-6:
                break
            taken += r["n"]
        else:
            return float("inf")
        low, high = r["low"], r["high"]
        if r["rows"] <= PIECE or low == high:
            break
    inside = copies.where((F.col("at") >= low) & (F.col("at") <= high)).groupBy("at").agg(F.sum("size").alias("n"))
    fits = (inside.withColumn("upto", F.sum("n").over(Window.orderBy("at")) + F.lit(taken))
            .where(F.col("upto") <= budget + 1e-6).agg(F.max("at")).first()[0])
    # nothing of the range fits: the horizon is just before it
    return fits if fits is not None else math.nextafter(low, -1.0)


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs``, all columns, with ``times`` (1 or more): the documents the mix takes, and how often.

    Where ``docs`` has a column of that name, in whatever case, the new one is
    ``mix_times`` (``mix_mix_times``, and so on).  A null text has no words; equal
    rows are taken alike; a source of no words is never taken.

    A source's queue is taken from its front, so a document's count follows
    from the last place taken in each round: one small row per source, and no
    text is shuffled.
    """
    m = mix(docs, doc_id, text, source)
    place = F.struct("shuffled", "key", "size")
    last = written(m.taken().groupBy("source").agg(*[
        F.max(F.when(F.col("times") > e, place)).alias(f"_last{e}") for e in range(REPEATS)]), "mix-last")
    last = last.withColumnRenamed("source", "_source")
    here = F.struct(F.xxhash64(F.col(doc_id).cast("string"), F.lit(5)),
                    F.coalesce(F.col(doc_id).cast("string"), F.lit("")), n_words(F.col(text)))
    rows = docs.select(F.struct("*").alias("row"), here.alias("place"), F.col(source).alias("source"))
    rows = rows.join(last, F.col("source").eqNullSafe(F.col("_source")), "left")
    times = sum(F.coalesce((F.col("place") <= F.col(f"_last{e}")).cast("int"), F.lit(0)) for e in range(REPEATS))
    name, names = "times", {c.lower() for c in docs.columns}
    while name in names:
        name = "mix_" + name
    return rows.withColumn("times", times).where(F.col("times") > 0).select("row.*", F.col("times").alias(name))


def op5(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).taken().select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))
