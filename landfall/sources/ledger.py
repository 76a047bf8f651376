"""Ledger of deliveries (S09, S10): what arrived, under which name, with which content.

A delivery is known by its stem: the name of its file up to the first dot, or
that of the folder a Spark job wrote.  The same stem may come again, from
another folder or under the same path.  The ledger decides by content (an
order-free fingerprint of the rows): equal content is a ``duplicate`` and
changes nothing, other content ``replaced`` what the stem held before, and
files that only join those already loaded from the same place are ``added``.
A month whose needed columns are mostly null is ``held``: it stays out until a
better delivery of its stem arrives.

Two append-only tables: ``ledger/deliveries`` (a row per stem, period and
version) and ``ledger/files`` (the files read).  The second is written last: a
load that broke off before has no files there, and its version is used again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.fingerprint import FINGERPRINT
from landfall.schemas import PERIOD_COLUMN
from landfall.sources.warehouse import Warehouse

LOADED = ("replaced", "added")
FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("length", T.LongType()),
                      T.StructField("modified", T.TimestampType()), T.StructField("stem", T.StringType()),
                      T.StructField("location", T.StringType()), T.StructField("version", T.LongType())])
DELIVERIES = T.StructType([T.StructField("stem", T.StringType()), T.StructField(PERIOD_COLUMN, T.StringType()),
                           T.StructField("location", T.StringType()), T.StructField("action", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in FINGERPRINT], T.StructField("version", T.LongType())])


def merged(parts: list[list[int]]) -> list[int]:
    """One fingerprint of those of disjoint parts."""
    out = [0, 0, 0, 0]
    for n, x, a, b in parts:
        out = [out[0] + n, out[1] ^ x, out[2] + a, out[3] + b]
    return out


def _unit(path: Column) -> tuple[Column, Column]:
    """(name of the delivered file or Spark-written folder, the folder it lies in)."""
    name, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    part = name.startswith("part-")
    one = F.regexp_replace(path, "/[^/]*$", "")
    return F.when(part, folder).otherwise(name), F.when(part, F.regexp_replace(one, "/[^/]*$", "")).otherwise(one)


def delivery_stem(path: str | Column) -> Column:
    """``a/i94_jan96_sub.csv`` and ``b/i94_jan96_sub.parquet/part-0.parquet`` -> ``i94_jan96_sub``;
    ``source_period=jan96/part-0.parquet`` -> ``jan96``."""
    unit, _ = _unit(F.col(path) if isinstance(path, str) else path)
    return F.regexp_replace(F.substring_index(unit, ".", 1), f"^{PERIOD_COLUMN}=", "")


def delivery_location(path: str | Column) -> Column:
    """The folder that holds the delivered file or folder."""
    return _unit(F.col(path) if isinstance(path, str) else path)[1]


@dataclass
class Ledger:
    """The two tables under one warehouse."""

    warehouse: Warehouse

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"ledger/{name}"
        if self.warehouse.exists(path):
            return self.warehouse.spark.read.schema(schema).parquet(self.warehouse.path(path))
        return self.warehouse.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def files(self) -> DataFrame:
        """The newest state of every file read: FILES."""
        rows = self._read("files", FILES)
        others = [f.name for f in FILES.fields if f.name != "file"]
        newest = rows.groupBy("file").agg(F.max_by(F.struct(*others), F.col("version")).alias("last"))
        return newest.select("file", "last.*")

    def deliveries(self, before: int | None = None) -> DataFrame:
        """Every row written, of versions below ``before``: DELIVERIES."""
        rows = self._read("deliveries", DELIVERIES)
        return rows if before is None else rows.where(F.col("version") < before)

    def next_version(self) -> int:
        return (self._read("files", FILES).agg(F.max("version")).first()[0] or 0) + 1

    def current(self, before: int | None = None) -> DataFrame:
        """The rows whose versions make up what each stem holds: its last replacement and what was added since."""
        rows = self.deliveries(before).where(F.col("action").isin(*LOADED))
        start = (rows.where(F.col("action") == "replaced").groupBy(F.col("stem").alias("_stem"))
                 .agg(F.max("version").alias("_start")))
        return rows.join(start, F.col("stem") == F.col("_stem")).where(F.col("version") >= F.col("_start")).drop("_stem", "_start")

    def state(self, stems: list[str], before: int) -> dict[str, dict]:
        """What each of ``stems`` holds, by the versions below ``before``: its location, fingerprint, versions, periods and
        files.  Stems that hold nothing are absent.  Goes through the driver: the rows of these stems alone."""
        out: dict[str, dict] = {}
        mine = F.col("stem").isin(stems) & (F.col("version") < before)
        rows = self._read("deliveries", DELIVERIES).where(mine & F.col("action").isin(*LOADED)).collect()
        for r in sorted(rows, key=lambda r: r["version"]):
            s = out.get(r["stem"])
            if s is None or r["action"] == "replaced" and r["version"] not in s["versions"]:
                s = out[r["stem"]] = {"location": r["location"], "content": [0] * 4, "versions": set(), "periods": set(), "files": {}}
            s["versions"].add(r["version"])
            s["periods"].add(r[PERIOD_COLUMN])
            s["content"] = merged([s["content"], [r[c] for c in FINGERPRINT]])
        for r in self._read("files", FILES).where(mine).orderBy("version").collect() if out else []:
            s = out.get(r["stem"])
            if s and r["location"] == s["location"] and r["version"] >= min(s["versions"]):
                s["files"][r["file"]] = (r["length"], r["modified"])
        return out

    def waiting(self) -> DataFrame:
        """Held deliveries that no later one of their stem has settled."""
        rows = self.deliveries()
        settled = (rows.where(F.col("action") != "held").groupBy(F.col("stem").alias("_stem"))
                   .agg(F.max("version").alias("_last")))
        held = rows.where(F.col("action") == "held")
        return (held.join(settled, F.col("stem") == F.col("_stem"), "left")
                .where(F.col("_last").isNull() | (F.col("_last") < F.col("version"))).drop("_stem", "_last"))

    def write(self, name: str, rows: DataFrame, version: int) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(self.warehouse.path(f"ledger/{name}/version={version}"))
