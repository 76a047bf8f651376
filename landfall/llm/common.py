"""Helpers shared by the operators: tables, splits, written intermediates, hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import freed_shuffles, scratch_path

SPACES = b" \t\n\x0b\x0c\r"

#: splitmix64 finaliser constants and two odd polynomial bases (fixed values).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id's text, modulo m; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % m


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the lineage ends there, and the write's shuffles leave the disk."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing will read again."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    scratch = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "")).getParent().toUri().getPath()
    for folder in {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).getParent().toString() for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() != scratch or not path.getName().startswith("llm-"):
            raise ValueError(f"{folder} is not an intermediate table")
        path.getFileSystem(conf).delete(path, True)


def most_frequent(df: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows of the largest counts (1 or more), at most ``limit`` of them, without a global sort.

    Counts fall into narrow logarithmic ranges; a range is taken whole or not.
    """
    number = F.floor(F.log2(count) * 16)
    lowest, taken = None, 0
    for r in df.groupBy(number.alias("k")).count().orderBy(F.desc("k")).collect():  # 1,024 ranges at most
        if taken + r["count"] > limit:
            break
        lowest, taken = r["k"], taken + r["count"]
    return df.where(F.lit(False) if lowest is None else number >= lowest)


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that few texts are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def broadcast(spark: SparkSession, data):
    """Broadcast of plain data that a worker turns into its working form once; see ``kept``."""
    return spark.sparkContext.broadcast({"data": data})


def kept(b, build):
    """``build(data)`` of a broadcast, kept by the Python worker for later tasks."""
    if "built" not in b.value:
        b.value["built"] = build(b.value["data"])
    return b.value["built"]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective mix of uint64 values (splitmix64's finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


class SubstringHash:
    """Polynomial hashes modulo 2**64 of any byte ranges of a text, vectorised.

    With S the running sum of table[byte] * base**i, the hash of [s, e) is
    (S[e] - S[s]) * base**-s, then mixed.  The powers are kept up to the
    longest text seen.
    """

    def __init__(self, seed: int = 0):
        self.base = np.uint64(BASES[seed])
        self.inverse = np.uint64(pow(BASES[seed], -1, 1 << 64))
        self.table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[1 - seed]))
        self.power = self.unpower = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n >= len(self.power):
            size = max(1 << 14, 2 * n)
            for name, b in (("power", self.base), ("unpower", self.inverse)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, a: np.ndarray) -> np.ndarray:
        self._grow(len(a) + 1)
        s = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.table[a] * self.power[:len(a)], out=s[1:])
        return s

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self.unpower[start])


def word_ranges(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the runs of True."""
    edge = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def signed(h: np.ndarray) -> np.ndarray:
    """uint64 bits as int64, for a bigint column."""
    return h.astype(np.uint64).view(np.int64)
