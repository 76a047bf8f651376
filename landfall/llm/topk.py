"""Exact top-k search by columnar branch and bound (operator 10).

Vectors are quantised to integers and laid out dimension by dimension.
Queries come in blocks against all vectors: inner products grow block of
dimensions by block of dimensions, and after each block a candidate stays only
if what it has plus the most that the remaining dimensions can give reaches
the query's k-th best lower bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from landfall.llm.common import broadcast, table, written

K, SCALE, EVERY = 10, 1024.0, 100
#: Queries of a pass over the vectors, vectors scored together, dimensions of a block.
QUERY_BLOCK, VECTOR_BLOCK, DIM_BLOCK = 2048, 8192, 16
LONG = (-(1 << 63), (1 << 63) - 1)


def quantise(vector) -> np.ndarray | None:
    """floor(1024 * x) of each component; None if the vector is null or holds null, NaN or infinity."""
    if vector is None:
        return None
    v = np.array([np.nan if x is None else x for x in vector], np.float64)
    return np.floor(SCALE * v) if np.isfinite(v).all() else None


def by_size(ids: list, vectors: list) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Usable vectors by their number of dimensions, in layers: ids, each once in a layer, and a (dimension, vector) matrix.

    Equal (id, vector) rows count once; further vectors of an id go to further layers.
    """
    groups: dict[int, list[tuple[list, list]]] = {}
    seen, layer = set(), {}
    for i, v in zip(ids, vectors):
        q = quantise(v)
        if q is not None and i is not None and (i, q.tobytes()) not in seen:
            seen.add((i, q.tobytes()))
            at = layer[i, len(q)] = layer.get((i, len(q)), -1) + 1
            layers = groups.setdefault(len(q), [])
            if at == len(layers):
                layers.append(([], []))
            layers[at][0].append(i)
            layers[at][1].append(q)
    return {d: [(np.array(i, np.int64), np.array(m).reshape(len(i), d).T.copy()) for i, m in layers]
            for d, layers in groups.items()}


def exact_product(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product in whole numbers, held within a long."""
    return max(LONG[0], min(LONG[1], sum(int(x) * int(y) for x, y in zip(a, b))))


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int = K,
           block: int = DIM_BLOCK) -> list[tuple[int, int, int]]:
    """The k best (query, candidate, score) of each query among the columns of ``c``.

    Where all sums stay below 2**53 doubles are exact whole numbers;
    beyond that the products are made with Python's integers.
    """
    dims = len(q)
    out = []
    if not len(c_ids) or not len(q_ids):
        return out
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dims
    if top >= 2 ** 52:
        for i, x in zip(q_ids, q.T):
            s = sorted(((-exact_product(x, y), int(j)) for j, y in zip(c_ids, c.T) if j != i))[:k]
            out += [(int(i), j, -v) for v, j in s]
        return out
    edges = list(range(0, dims, block)) + [dims]
    rest_q = [np.sqrt((q[e:] ** 2).sum(axis=0)) for e in edges]
    rest_c = [np.sqrt((c[e:] ** 2).sum(axis=0)) for e in edges]
    first = q[:block].T @ c[:block]  # all queries and candidates, first block of dimensions
    for n, i in enumerate(q_ids):
        alive = np.flatnonzero(c_ids != i)
        score = first[n, alive]
        for b in range(1, len(edges) - 1):
            slack = rest_q[b][n] * rest_c[b][alive] * (1 + 1e-9) + 1  # most that is left to come or go
            if len(alive) > k:
                low = score - slack
                bound = np.partition(low, len(low) - k)[len(low) - k]
                stay = score + slack >= bound
                alive, score = alive[stay], score[stay]
            score = score + q[edges[b]:edges[b + 1], n] @ c[edges[b]:edges[b + 1]][:, alive]
        best = np.lexsort((c_ids[alive], -score))[:k]
        out += [(int(i), int(c_ids[alive[j]]), int(score[j])) for j in best]
    return out


def top_k(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best partners of each vector whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Each pass broadcasts one block of queries and reads all vectors; a task
    hands on at most k rows per query and batch.  Null ids, null vectors and
    those with null or non-finite components take no part; vectors of another
    number of dimensions are no candidates.  Ties go to the smaller id; equal
    rows that repeat an id count once.  An id with several vectors stands in a
    ranking once, with the best score that any of its vectors has with any of
    the other id's.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    usable = F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    queries = rows.where((F.col("id") % every == 0) & usable).dropDuplicates(["id", "v"])

    def part(block: list):
        b = broadcast(spark, block)

        def run(batches):
            mine = by_size([i for i, _ in b.value["data"]], [v for _, v in b.value["data"]])
            for batch in batches:
                for s in range(0, batch.num_rows, VECTOR_BLOCK):
                    piece = batch.slice(s, VECTOR_BLOCK)
                    found = []
                    for d, layers in by_size(piece.column("id").to_pylist(), piece.column("v").to_pylist()).items():
                        found += [f for q_ids, q in mine.get(d, []) for ids, c in layers for f in search(q_ids, q, ids, c, k)]
                    yield pa.RecordBatch.from_pydict({
                        n: pa.array([f[j] for f in found], pa.int64())
                        for j, n in enumerate(("query_id", "vec_id", "score"))})

        return rows.mapInArrow(run, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(df: DataFrame) -> DataFrame:
        return (df.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    block, out = [], None
    for r in queries.toLocalIterator(prefetchPartitions=True):
        block.append((r["id"], r["v"]))
        if len(block) == query_block:
            done = written(ranked(part(block)), "top-k")
            out, block = done if out is None else out.unionByName(done), []
    if block or out is None:
        last = ranked(part(block))
        out = last if out is None else out.unionByName(last)
    # vectors of one query id may fall into several blocks
    return ranked(out)


def op10(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE_OP10 = """
WITH v AS (SELECT DISTINCT ON (vec_id) vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
