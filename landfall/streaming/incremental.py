"""Incremental loading of new and corrected extract files.

A stream over the inbox's file names, run with ``trigger(availableNow=True)``,
finds the files that arrived since the last run; files that changed under the
same path are found by comparing the inbox with the ledger.  Either way they
make a delivery (``sources.ledger``):

1. its files are landed under ``stem=/version=/source_period=``;
2. one aggregate over the landed rows gives, per stem and period, the content
   fingerprint and the null profile, which are stored;
3. the ledger decides: equal content is dropped, other content replaces what
   the stem held, files that only join others are added, and a month whose
   needed columns are mostly null is held back and reported;
4. the new rows alone are summed to the staging grain and stored as a partial
   of their stem and version;
5. the touched periods are staged again by merging their partials: a late file
   or a correction never reads the rest of its month from the lake;
6. with ``refresh_star`` the star follows (``plans.flows.refresh_star``).

Everything up to the files' entry in the ledger can run again: a load that
broke off is repeated under the same version and overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.fingerprint import FINGERPRINT, fingerprint
from landfall.functions.periods import in_periods
from landfall.operators.joins import bounded_broadcast
from landfall.operators.lookups import Lookups
from landfall.operators.profile import (NULL_PREFIX, fill_text, merged_profile, profile_counts, ratio_over, sparse_columns,
                                        type_extract)
from landfall.operators.rejects import bad_counts, rejected_cells, rejects_of
from landfall.operators.staging import build_staging
from landfall.plans.flows import arrival_years, refresh_star
from landfall.schemas import (I94_RAW, I94_RAW_COLUMNS, I94_RAW_TEXT, NULL_RATIO_LIMIT, PERIOD_COLUMN, REQUIRED_COLUMNS,
                              STAGING, STAGING_KEYS)
from landfall.session import open_files
from landfall.sources.landing import list_files, read_extracts
from landfall.sources.ledger import DELIVERIES, FILES, LOADED, Ledger, delivery_location, delivery_stem, merged
from landfall.sources.warehouse import Warehouse

STREAMED = "path string, modificationTime timestamp, length long, content binary"
VERSION_OF = ["stem", "version"]
FOLDERS = T.StructType([T.StructField("stem", T.StringType()), T.StructField("version", T.LongType()),
                        T.StructField(PERIOD_COLUMN, T.StringType())])
PARTIALS = T.StructType([*[f for f in STAGING.fields if f.name in (*STAGING_KEYS, "count")], T.StructField(PERIOD_COLUMN, T.StringType()),
                         T.StructField("stem", T.StringType()), T.StructField("version", T.LongType())])
REJECTS = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("cell", T.StringType()),
                        T.StructField("cells", T.LongType()), T.StructField(PERIOD_COLUMN, T.StringType()),
                        T.StructField("stem", T.StringType()), T.StructField("version", T.LongType())])


class IncrementalLoader:
    """Inbox -> lake -> staging, one delivery per run of new files.

    A delivery takes at most ``max_files_per_trigger`` new files.  Their names,
    and a few numbers per stem and period, pass through the driver; a run goes
    on until no new file is left.  ``seed_unknown`` adds the unknown members to
    the dimensions that have one.
    """

    def __init__(self, spark: SparkSession, inbox: str, warehouse: Warehouse, lookups: Lookups,
                 checkpoint: str | None = None, fmt: str = "parquet", schema=None,
                 max_files_per_trigger: int = 1000, refresh_star: bool = False, seed_unknown: bool = False):
        self.spark = spark
        self.inbox = inbox
        self.warehouse = warehouse
        self.lookups = lookups
        self.checkpoint = checkpoint or warehouse.path("_checkpoints/extracts")
        self.fmt = fmt
        self.schema = schema
        self.max_files = max_files_per_trigger
        self.refresh = refresh_star
        self.seed_unknown = seed_unknown
        self.ledger = Ledger(warehouse)

    # -- finding files ---------------------------------------------------------

    def _stream(self) -> DataFrame:
        files = (self.spark.readStream.format("binaryFile").schema(STREAMED).option("recursiveFileLookup", True)
                 # a late or copied month may be far older than the newest file seen
                 .option("maxFileAge", "36500d").option("maxFilesPerTrigger", self.max_files).load(self.inbox))
        return files.select(F.col("_metadata.file_path").alias("file"))

    def _listing(self) -> DataFrame:
        """The inbox's files with their deliveries: (file, length, modified, stem, location)."""
        return list_files(self.spark, self.inbox).select("*", delivery_stem("file").alias("stem"),
                                                         delivery_location("file").alias("location"))

    def _unread(self, listing: DataFrame | None = None) -> DataFrame:
        """Files of the inbox that the ledger does not know as they are."""
        known = self.ledger.files().select(F.col("file").alias("_file"), F.col("length").alias("_length"),
                                           F.col("modified").alias("_modified"))
        same = (F.col("file") == F.col("_file")) & (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
        return (self._listing() if listing is None else listing).join(known, same, "left_anti")

    def missing_files(self) -> DataFrame:
        """``(file)`` of the inbox that no delivery has read."""
        return self._unread().select("file")

    def run(self) -> None:
        """Process every new or changed file, then return."""
        q = (self._stream().writeStream
             .option("checkpointLocation", self.checkpoint)
             .trigger(availableNow=True)
             .foreachBatch(lambda batch, _: self._deliver([r["file"] for r in batch.distinct().collect()]))
             .start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        while changed := [r["file"] for r in self._unread().limit(self.max_files).collect()]:
            self._deliver(changed)

    # -- one delivery ----------------------------------------------------------

    def _deliver(self, files: list[str]) -> None:
        listing = self._listing().persist()  # file names and sizes
        try:
            unread = [r.asDict() for r in self._unread(listing).where(F.col("file").isin(files)).collect()]
            if not unread:
                return  # a load that was repeated after its entry in the ledger
            new = {f["file"] for f in unread}
            places = {(f["stem"], f["location"]) for f in unread}
            there = [r.asDict() for r in listing.where(F.col("stem").isin(sorted({s for s, _ in places}))).collect()]
        finally:
            listing.unpersist()
        version = self.ledger.next_version()
        holds = self.ledger.state(sorted({s for s, _ in places}), version)
        chosen, entries = self._choose([f for f in there if (f["stem"], f["location"]) in places], new, holds)
        self._land([f["file"] for f in chosen], version)
        rows = self._judge(entries, holds, version)
        actions = {r["stem"]: r["action"] for r in rows}
        loaded = [s for s, a in actions.items() if a in LOADED]
        replaced = [s for s in loaded if actions[s] == "replaced" and s in holds]
        # periods that replaced contents had, and those of the new ones
        periods = {p for s in replaced for p in holds[s]["periods"]} | {
            r[PERIOD_COLUMN] for r in rows if r["stem"] in loaded and r["row_count"]}
        if loaded:
            self._sum_up(loaded, version)
        kept = [s for s, a in actions.items() if a != "duplicate"]  # a month may be held for its rejected cells
        self._reject([f["file"] for f in chosen if f["stem"] in kept], kept, version)
        self.ledger.write("deliveries", self._table(rows, DELIVERIES), version)
        if periods:
            self._restage(sorted(periods, key=lambda p: (p is not None, p)))
        seen = chosen + [f for e in entries.values() for f in e["passed_over"]]
        self.ledger.write("files", self._table(seen, FILES), version)
        self._clean(replaced, [s for s, a in actions.items() if a == "duplicate"], version)

    def _table(self, rows: list[dict], schema: T.StructType) -> DataFrame:
        fields = [f for f in schema.fields if f.name != "version"]  # the folder's name
        return self.spark.createDataFrame([tuple(r[f.name] for f in fields) for r in rows], T.StructType(fields))

    def _choose(self, listing: list[dict], new: set[str], holds: dict[str, dict]) -> tuple[list[dict], dict[str, dict]]:
        """(files to read, per stem how they stand to what it holds).

        Of several folders that bring one stem at a time, the one with the
        newest file counts.
        """
        stems: dict[str, dict[str, list[dict]]] = {}
        for f in listing:
            stems.setdefault(f["stem"], {}).setdefault(f["location"], []).append(f)
        chosen, entries = [], {}
        for stem, places in stems.items():
            newest = max(places, key=lambda p: (max(f["modified"] for f in places[p] if f["file"] in new), p))
            here, held = places[newest], holds.get(stem)
            state = {f["file"]: (f["length"], f["modified"]) for f in here}
            joins = (held is not None and held["location"] == newest and held["files"]
                     and all(state.get(f) == x for f, x in held["files"].items()))
            chosen += [f for f in here if f["file"] in new] if joins else here
            entries[stem] = {"action": "added" if joins else "replaced", "location": newest,
                             "passed_over": [f for p in places if p != newest for f in places[p] if f["file"] in new]}
        return chosen, entries

    def _land(self, files: list[str], version: int) -> None:
        rows = read_extracts(self.spark, files, self.fmt, self.schema, more={"stem": delivery_stem})
        with open_files(self.spark):
            (rows.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("stem", "version", PERIOD_COLUMN)
             .parquet(self.warehouse.path("lake_i94")))

    def _judge(self, entries: dict[str, dict], holds: dict[str, dict], version: int) -> list[dict]:
        """The ledger's rows of this version; fingerprints and null profile come from one aggregate over the landed rows."""
        landed = self.lake().where(F.col("version") == version)
        counts = profile_counts(landed, ["stem", PERIOD_COLUMN], [*fingerprint(I94_RAW_COLUMNS), *bad_counts(landed)])
        counts.write.mode("overwrite").parquet(self.warehouse.path(f"profile_counts/version={version}"))
        measured = self.warehouse.read("profile_counts").where(F.col("version") == version).collect()
        out = []
        for stem, e in entries.items():
            mine = [r for r in measured if r["stem"] == stem]
            action = e["action"]
            content = merged([[r[c] for c in FINGERPRINT] for r in mine])
            if action == "replaced" and stem in holds and content == holds[stem]["content"]:
                action = "duplicate"
            elif any(ratio_over(r[NULL_PREFIX + c], r["row_count"]) for r in mine for c in REQUIRED_COLUMNS):
                action = "held"
            for r in mine or [{PERIOD_COLUMN: None, **dict.fromkeys(FINGERPRINT, 0)}]:
                out.append({"stem": stem, "location": e["location"], "action": action, PERIOD_COLUMN: r[PERIOD_COLUMN],
                            **{c: r[c] for c in FINGERPRINT}})
        return out

    def _sum_up(self, stems: list[str], version: int) -> None:
        """Store this version's partial staging sums, by stem and period."""
        rows = self.lake().where((F.col("version") == version) & F.col("stem").isin(stems))
        clean = fill_text(type_extract(rows.select("stem", *REQUIRED_COLUMNS, PERIOD_COLUMN)), STAGING_KEYS)
        parts = clean.groupBy(*STAGING_KEYS, PERIOD_COLUMN, "stem").agg(F.sum("count").alias("count"))
        self.warehouse.write("stage_partials", parts.withColumn("version", F.lit(version).cast("long")),
                             partition_by=[PERIOD_COLUMN, "stem", "version"], rebalance=True)

    def _reject(self, files: list[str], stems: list[str], version: int) -> None:
        """Store the cells of this version that did not parse; CSV cells are looked up in the files themselves."""
        if not files:
            return
        by = [PERIOD_COLUMN, "stem"]
        if self.fmt == "csv":
            rows = rejected_cells(read_extracts(self.spark, files, "csv", self.schema, more={"stem": delivery_stem}, cells=True), by)
        else:
            stored = self.warehouse.read("profile_counts").where((F.col("version") == version) & F.col("stem").isin(stems))
            rows = rejects_of(self.lake().where((F.col("version") == version) & F.col("stem").isin(stems)), stored, by)
        if rows is not None:
            self.warehouse.write("rejects", rows.withColumn("version", F.lit(version).cast("long")),
                                 partition_by=[PERIOD_COLUMN, "stem", "version"])

    def rejects(self) -> DataFrame:
        """``(source_period, stem, column_name, cell, cells)``: cells that did not parse, of the versions that count or are held."""
        if not self.warehouse.exists("rejects"):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in REJECTS.fields]).drop("version")
        shown = self.ledger.current().select(*VERSION_OF).unionByName(self.ledger.waiting().select(*VERSION_OF)).distinct()
        rows = self.spark.read.schema(REJECTS).parquet(self.warehouse.path("rejects"))
        return rows.join(bounded_broadcast(shown), VERSION_OF, "left_semi").drop("version")

    def _counting(self, rows: DataFrame) -> DataFrame:
        """The rows of versions that make up what their stems hold now."""
        now = bounded_broadcast(self.ledger.current().select(*VERSION_OF).distinct())
        return rows.join(now, VERSION_OF, "left_semi")

    def partials(self, periods: list) -> DataFrame:
        """The partial sums that make up ``periods`` now."""
        rows = self.spark.read.schema(PARTIALS).parquet(self.warehouse.path("stage_partials"))
        return self._counting(rows.where(in_periods(PERIOD_COLUMN, periods)))

    def _restage(self, periods: list) -> None:
        # arrival years these periods covered before and after re-staging:
        # exactly the fact partitions that can change
        before = (arrival_years(self.warehouse.read_staging(), periods)
                  if self.refresh and self.warehouse.exists("immigration_stage") else set())
        staged = self.warehouse.write_staging(build_staging(self.partials(periods), self.lookups), periods)
        if self.refresh:
            refresh_star(self.warehouse, before | arrival_years(staged, periods), periods, self.seed_unknown)

    def _clean(self, replaced: list[str], duplicates: list[str], version: int) -> None:
        """Remove files that count no more: of replaced contents the older versions, of duplicates this one."""
        if not replaced and not duplicates:
            return
        gone = (F.col("stem").isin(replaced) & (F.col("version") < version)) | (
            F.col("stem").isin(duplicates) & (F.col("version") == version))
        for name in ("lake_i94", "stage_partials", "rejects"):
            if self.warehouse.exists(name):
                files = self.spark.read.schema(FOLDERS).parquet(self.warehouse.path(name)).where(gone)
                self.warehouse.remove([r[0] for r in files.select(F.col("_metadata.file_path")).distinct().collect()])

    # -- what is held ------------------------------------------------------------

    def lake(self) -> DataFrame:
        """Landed rows with their stem, version and period; versions that count no more may still be among them."""
        return self.spark.read.schema(self._lake_schema()).parquet(self.warehouse.path("lake_i94"))

    def _lake_schema(self) -> T.StructType:
        own = self.schema or (I94_RAW_TEXT if self.fmt == "csv" else I94_RAW)
        return T.StructType([*own.fields, T.StructField("stem", T.StringType()), T.StructField("version", T.LongType()),
                             T.StructField(PERIOD_COLUMN, T.StringType())])

    def current_lake(self) -> DataFrame:
        """Landed rows of the versions that count."""
        return self._counting(self.lake())

    def profile_counts(self) -> DataFrame:
        """Stored null counts of the versions that count, by stem and period."""
        return self._counting(self.warehouse.read("profile_counts"))

    def profiled(self) -> DataFrame:
        """Every month typed and cleaned under one schema: columns are dropped by the null counts of all months
        together, however the months arrived (F02, P11)."""
        return fill_text(type_extract(self.current_lake().drop(*VERSION_OF)).drop(*sparse_columns(self.profile_counts())))

    def held_back(self) -> DataFrame:
        """``(stem, source_period, column_name, null_rows, total_rows)``: why a delivery is not staged."""
        waiting = self.ledger.waiting().select(*VERSION_OF).distinct()
        counts = self.warehouse.read("profile_counts").join(waiting, VERSION_OF, "left_semi")
        rows = merged_profile(counts, ["stem", PERIOD_COLUMN])
        return rows.where(F.col("column_name").isin(REQUIRED_COLUMNS) & (F.col("null_rows") / F.col("total_rows") > NULL_RATIO_LIMIT))
