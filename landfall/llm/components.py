"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import written


def _edges(df: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b."""
    return (df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where(F.col("a") < F.col("b")).distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the edge table (a, b); component is its smallest node.

    Each round hooks every node on its smallest smaller neighbour, follows the
    hooks to the trees' roots by doubling, and replaces both ends of every
    edge by their roots; edges within one tree vanish.  Stars take one round;
    rounds and doublings grow with the logarithm of the table.  All tables are
    written, so lineage stays short; minima are partial aggregates, and joins
    of written tables let Spark split a node with very many neighbours.
    """
    now = written(_edges(edges), "edges")
    labels = None
    for _ in range(max_rounds):
        if not now.head(1):
            break
        ends = now.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a").alias("to")),
                                            F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("e"))
        hook = _roots(written(ends.select("e.*").groupBy("node").agg(F.min("to").alias("to")), "hooks"))
        a, b = (hook.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in ("a", "b"))
        now = written(_edges(now.join(a, "a").join(b, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))),
                      "edges")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = written(labels.join(step, "component", "left")
                             .select("node", F.coalesce("to", "component").alias("component")), "labels")
    else:
        raise RuntimeError("components did not settle")
    return labels if labels is not None else now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _roots(hook: DataFrame) -> DataFrame:
    """Follow (node, to) to the root of every tree, twice as far each time."""
    while True:
        up = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
        far = written(hook.join(up, "to").select("node", "to", "next"), "hooks")
        done = not far.where(F.col("to") != F.col("next")).head(1)
        hook = far.select("node", F.col("next").alias("to"))
        if done:
            return hook
