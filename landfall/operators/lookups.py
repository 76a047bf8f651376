"""Typed lookup tables from parsed label lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.labels import int_code, port_code, state_code
from landfall.operators.joins import bounded_broadcast

# Label (file stem) names and which code rule each follows.
CITIZENSHIP = "I94CIT_I94RES"
PORT = "I94Port"
STATE = "i94addr"
MODE = "I94Mode"
VISA = "I94Visa"
TEXT_CODE_LABELS = {PORT: port_code, STATE: state_code}


def lookup_table(parsed: DataFrame, label: str) -> DataFrame:
    """``(code, value)`` for one label: string codes for port and state,
    int codes for everything else."""
    rows = parsed.where(F.col("label") == label)
    rule = TEXT_CODE_LABELS.get(label, int_code)
    return rows.select(rule("code").alias("code"), F.col("value").alias("value"))


def label_port(parsed: DataFrame) -> DataFrame:
    return lookup_table(parsed, PORT)


def label_addr(parsed: DataFrame) -> DataFrame:
    return lookup_table(parsed, STATE)


def label_int(parsed: DataFrame) -> DataFrame:
    """``(label, code int, value)`` for every label that is not text-coded, listed here or not."""
    return (parsed.where(~F.col("label").isin(*TEXT_CODE_LABELS))
            .select("label", int_code("code").alias("code"), "value"))


NAMES = ("visa", "citizenship", "state", "port", "mode")
TEXT_CODED = ("state", "port")


@dataclass
class Lookups:
    """The five lookups the staging step joins."""

    visa: DataFrame
    citizenship: DataFrame
    state: DataFrame
    port: DataFrame
    mode: DataFrame
    # True once each side carries a broadcast hint decided by a size check.
    sized: bool = False

    @classmethod
    def from_parsed(cls, parsed: DataFrame) -> "Lookups":
        return cls(
            visa=lookup_table(parsed, VISA),
            citizenship=lookup_table(parsed, CITIZENSHIP),
            state=lookup_table(parsed, STATE),
            port=lookup_table(parsed, PORT),
            mode=lookup_table(parsed, MODE),
        )

    def materialize(self, spark, path: str) -> "Lookups":
        """Write all five as one small table (one job, partitioned by lookup
        name) and read each back, so later joins scan a few kilobytes
        instead of re-parsing the label files."""
        parts = [getattr(self, n).select(F.lit(n).alias("lookup"), F.col("code").cast("string").alias("code"),
                                         "value") for n in NAMES]
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        both.hint("rebalance", "lookup").write.mode("overwrite").partitionBy("lookup").parquet(path)
        return Lookups.read(spark, path)

    @classmethod
    def read(cls, spark, path: str) -> "Lookups":
        table = spark.read.parquet(path)
        out = {}
        for n in NAMES:
            code = F.col("code") if n in TEXT_CODED else F.col("code").cast("int")
            out[n] = table.where(F.col("lookup") == n).select(code.alias("code"), "value")
        return cls(**out)

    def sized_for_broadcast(self, max_bytes: int) -> "Lookups":
        """Mark each lookup for broadcast if it takes at most ``max_bytes``; a larger one is left for a shuffle join."""
        if self.sized:
            return self
        return Lookups(sized=True, **{n: bounded_broadcast(getattr(self, n), max_bytes) for n in NAMES})
