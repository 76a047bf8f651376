"""Warehouse tables.

Default storage is a folder of Parquet tables (one sub-folder per table),
which any Spark cluster can share.  A JDBC database can be used instead
through :func:`write_jdbc` / :func:`read_jdbc`; the reader always splits the
scan over a numeric column so it is not a single task.
"""

from __future__ import annotations

import os
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.periods import in_periods
from landfall.operators.star import Star
from landfall.schemas import CONTRACTS, PERIOD_COLUMN, STAR_TABLES, Contract
from landfall.session import open_files

YEAR_PARTITION = "arrival_year"
# Columns that stored tables add to their contract, as folders.
PARTITIONS = [YEAR_PARTITION, PERIOD_COLUMN]
# Row order inside each fact file: the warehouse sort key.  Parquet keeps
# min/max per row group, so a range on ``arrdate`` skips most row groups.
FACT_SORT = ["arrdate", "i94mode", "visatype", "i94cit", "i94port", "i94addr"]


@dataclass
class Warehouse:
    """A set of Parquet tables under one root folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
              sort_by: list[str] | None = None, mode: str = "overwrite",
              rebalance: bool = False, replace_all: bool = False, spread: bool = False) -> DataFrame:
        """Write ``df`` as table ``name`` and return the table read back.

        With ``partition_by`` and dynamic partition overwrite, an overwrite
        replaces only the partitions present in ``df``, so re-running a batch
        is idempotent and leaves other batches alone.  ``replace_all=True``
        (a full rebuild) replaces the whole table, so a partition absent from
        ``df`` disappears.

        ``rebalance=True`` (for results of a shuffle, e.g. an aggregate)
        redistributes rows by the partition columns first: AQE then coalesces
        small partitions and splits a hot one into advisory-size pieces, so
        each output folder gets a few full files instead of one fragment per
        upstream task.  ``spread=True`` deals the folders over all shuffle
        partitions instead, whole: for counts that are small in every folder,
        where the folders take the time and a rebalance would give all of them
        to one task.  Without ``sort_by`` a task's rows are not sorted by folder
        either (``session.open_files``).
        """
        out = df
        if spread and partition_by:
            out = out.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), *partition_by)
        if rebalance and partition_by:
            out = out.hint("rebalance", *partition_by)
        if sort_by:
            out = out.sortWithinPartitions(*(partition_by or []), *sort_by)
        w = out.write.mode(mode).option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        if partition_by:
            w = w.partitionBy(*partition_by)
        with nullcontext() if sort_by else open_files(self.spark):
            w.parquet(self.path(name))
        # by the schema written: a table that got no row has no file to tell it
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        """Whether table ``name`` has been written; asks the file system, reads nothing."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = path.getFileSystem(conf)
        return fs.exists(path) and any(not f.getPath().getName().startswith("_temporary") for f in fs.listStatus(path))

    def files(self, name: str, where: Column | None = None) -> list[str]:
        """Paths of the table's files, of the partitions that ``where`` selects; no column is read."""
        if not self.exists(name):
            return []
        df = self.spark.read.parquet(self.path(name))
        df = df if where is None else df.where(where)
        return [r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()]

    def remove(self, files: list[str]) -> None:
        """Delete files through the file system that holds them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for f in files:
            p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
            p.getFileSystem(conf).delete(p, False)

    def write_parts(self, name: str, df: DataFrame | None, part: str, values: list, partition_by: list[str] | None = None,
                    sort_by: list[str] | None = None, rebalance: bool = False, spread: bool = False) -> None:
        """Replace the rows whose ``part`` is one of ``values`` in a table partitioned by it; all others stay.

        Dynamic overwrite leaves a partition alone that got no row this time:
        files of these values that were there before and still are belong to
        such partitions and go.  No ``df`` means no rows.  Should the driver be
        lost between the write and the removal, they stay until these values
        are written again.
        """
        mine = in_periods(part, values)
        before = set(self.files(name, mine))
        if df is not None:
            self.write(name, df, partition_by=partition_by or [part], sort_by=sort_by, rebalance=rebalance, spread=spread)
        if before:
            self.remove(sorted(before & set(self.files(name, mine))))

    def write_periods(self, name: str, df: DataFrame | None, periods: list, partition_by: list[str] | None = None,
                      sort_by: list[str] | None = None, rebalance: bool = False, spread: bool = False) -> None:
        """:meth:`write_parts` by period."""
        self.write_parts(name, df, PERIOD_COLUMN, periods, partition_by, sort_by, rebalance, spread)

    # -- staging and star ---------------------------------------------------
    def write_staging(self, staging: DataFrame, periods: list | None = None) -> DataFrame:
        """Write staging partitioned by arrival year and period.

        With ``periods`` (those that were processed) it replaces these, see
        :meth:`write_parts`; without, the whole table.
        """
        out = staging.drop(YEAR_PARTITION).withColumn(YEAR_PARTITION, F.year("arrdate"))
        parts = [YEAR_PARTITION] + ([PERIOD_COLUMN] if PERIOD_COLUMN in out.columns else [])
        if periods is None:
            self.write("immigration_stage", out, partition_by=parts, sort_by=["arrdate"], rebalance=True, replace_all=True)
        else:
            self.write_periods("immigration_stage", out, periods, parts, ["arrdate"], rebalance=True)
        return self.read_staging()

    def read_staging(self) -> DataFrame:
        return self.read("immigration_stage")

    def write_dimension(self, name: str, members: DataFrame) -> None:
        """Replace a dimension; its members are dealt over as many tasks as their size needs."""
        self.write(name, members.hint("rebalance"))

    def add_members(self, name: str, members: DataFrame) -> None:
        """Add the members that the stored dimension does not hold yet."""
        have = self.read(name)
        same = None
        for c in have.columns:
            eq = F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}"))
            same = eq if same is None else same & eq
        new = members.distinct().alias("n").join(have.alias("h"), same, "left_anti").persist()
        try:
            if new.head(1):
                self.write(name, new.hint("rebalance"), mode="append")
        finally:
            new.unpersist()

    def write_star(self, star: Star) -> Star:
        """Write (replace) the seven tables; the fact is partitioned by arrival
        year and sorted by the warehouse sort key inside each file."""
        tables = star.tables()
        fact = tables["immigration"].withColumn(YEAR_PARTITION, F.year("arrdate"))
        out = {"immigration": self.write("immigration", fact, partition_by=[YEAR_PARTITION],
                                         sort_by=FACT_SORT, rebalance=True, replace_all=True)}
        # The dimension members are few (labels and days); cached, the six
        # dimension writes share one scan of staging.  A lost cache block is
        # recomputed from the staging table.
        if star.members is not None:
            star.members.persist()
        try:
            for name in STAR_TABLES:
                if name != "immigration":
                    self.write_dimension(name, tables[name])
                    out[name] = self.read(name)
        finally:
            if star.members is not None:
                star.members.unpersist()
        return Star(staging=star.staging, **out)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every written table as a temporary view (``immigration``,
        ``visa``, ..., ``immigration_stage``) for ``spark.sql``; no metastore
        is needed.  Returns the view names."""
        names = []
        for name in STAR_TABLES + ["immigration_stage"]:
            if self.exists(name):
                self.read(name).createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        return names

    def register_tables(self, database: str) -> list[str]:
        """Define every written table in the session's catalog, as external tables of ``database`` by their contracts."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        names = []
        for name in STAR_TABLES + ["immigration_stage"]:
            if self.exists(name):
                table = f"`{database}`.`{name}`"
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
                stored = self.read(name).schema
                self.spark.sql(create_table_ddl(table, self.path(name), CONTRACTS[name], stored))
                if any(f.name in PARTITIONS for f in stored.fields):
                    self.spark.catalog.recoverPartitions(f"{database}.{name}")
                names.append(f"{database}.{name}")
        return names

    def read_star(self, with_staging: bool = True) -> Star:
        tables = {name: self.read(name) for name in STAR_TABLES}
        staging = self.read_staging() if with_staging and self.exists("immigration_stage") else None
        return Star(staging=staging, rollup=self.read("rollup") if self.exists("rollup") else None, **tables)


# -- JDBC ------------------------------------------------------------------

def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Append (or overwrite) ``df`` into a database table over JDBC.

    Each task opens one connection; ``num_partitions`` caps concurrent
    connections by repartitioning first (coalescing would also narrow the
    work above).  ``append`` adds the rows again when a load is repeated;
    ``overwrite`` replaces the table.
    """
    out = df.repartition(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size).mode(mode))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower_bound, upper_bound, num_partitions: int,
              properties: dict | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read a database table over JDBC in ``num_partitions`` parallel range scans."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("partitionColumn", partition_column)
         .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
         .option("numPartitions", num_partitions).option("fetchsize", fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def create_table_ddl(table: str, location: str, contract: Contract, stored: T.StructType) -> str:
    """``CREATE TABLE`` text of a written table by its contract: the declared columns in their order, each with its
    declared width, NOT NULL and references as its comment, the key as a table property, then the partition columns.

    Spark neither checks nor may assume such constraints of files written
    elsewhere; the quality checks test them.  Files that lack a declared column
    raise.
    """
    types = {f.name: f.dataType.simpleString() for f in stored.fields}
    absent = [c for c in contract.columns if c not in types]
    if absent:
        raise ValueError(f"{contract.name} lacks {absent}")
    columns = []
    for c in contract.columns:
        said = [f"VARCHAR({contract.widths[c]})"] if c in contract.widths else []
        said += ["NOT NULL"] if c in contract.not_null else []
        said += ["REFERENCES {0}({1})".format(*contract.foreign_keys[c])] if c in contract.foreign_keys else []
        columns.append(f"`{c}` {types[c]}" + (f" COMMENT '{' '.join(said)}'" if said else ""))
    parts = [c for c in PARTITIONS if c in types]
    columns += [f"`{c}` {types[c]}" for c in parts]
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    key = f" TBLPROPERTIES ('primary.key' = '{','.join(contract.key)}')" if contract.key else ""
    return f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet{by} LOCATION '{location}'{key}"
