"""Order-free fingerprints of row multisets.

Two sides hold the same rows, however they are split or ordered, exactly when
(up to hash collisions) they agree on the number of rows, the xor of one row
hash and two sums of hash parts.  All four are partial aggregates, and the
fingerprints of disjoint parts add up (the xor by xor) to that of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The parts of a fingerprint, in column order.
FINGERPRINT = ["row_count", "hash_xor", "hash_low", "hash_high"]


def _nulls(columns: list[str]) -> list[Column]:
    """Which cells are null, 32 a number: Spark's hashes pass over nulls, so a cell that moved would not show."""
    out = []
    for at in range(0, len(columns), 32):
        bits = [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                for i, c in enumerate(columns[at:at + 32])]
        out.append(reduce(lambda a, b: a + b, bits))
    return out


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's cells, null cells included."""
    cells = [*_nulls(columns), *[F.col(f"`{c}`") for c in columns]]
    return F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit(2), *cells)


def fingerprint(columns: list[str]) -> list[Column]:
    """Aggregates (row_count, hash_xor, hash_low, hash_high) of a group of rows.

    A sum adds 31 bits a row, so a group may have 2^32 rows.
    """
    one, two = row_hashes(columns)
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.bit_xor(one), F.lit(0)).cast("long").alias("hash_xor"),
            F.coalesce(F.sum(one.bitwiseAND(F.lit(0x7FFFFFFF))), F.lit(0)).cast("long").alias("hash_low"),
            F.coalesce(F.sum(F.shiftrightunsigned(two, 33)), F.lit(0)).cast("long").alias("hash_high")]
