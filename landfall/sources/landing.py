"""Landing (S01, S03, S09): raw inputs -> Parquet in the lake, unchanged.

Monthly extracts arrive either as files named ``i94_<mon><yy>_sub.<ext>``
or in ``source_period=<period>`` folders; either way each row gets its
``source_period`` and the lake table is partitioned by it.  Writes use
dynamic partition overwrite, so landing the same month twice replaces that
month instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.periods import period_from_path
from landfall.schemas import AIRPORTS, I94_RAW, I94_RAW_TEXT, PERIOD_COLUMN, REQUIRED_COLUMNS
from landfall.session import open_files


#: The text of a CSV row's cells, kept until those that do not parse are known.
CELLS = "_cells"
#: So many files at most have their names sent to every task; with more, each row works out its own.
NAMED_FILES = 50_000


def extract_schema(base: T.StructType = I94_RAW) -> T.StructType:
    """The raw schema plus the period column (filled from folder names when present)."""
    return T.StructType(list(base.fields) + [T.StructField(PERIOD_COLUMN, T.StringType(), True)])


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, length, modified)`` for every file under ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def with_path_columns(df: DataFrame, path: str | list[str], of: dict[str, Callable[[Column], Column]], keep: list[Column | str]) -> DataFrame:
    """``keep`` of a file scan and the columns that ``of`` makes from each row's file path.

    They are made once a file, from the listing, and joined by the path: pattern
    matching on every row takes as long as writing it.  A file that the listing
    lacks, as it came since, has them made row by row.
    """
    file = F.col("_metadata.file_path")
    if len(df.inputFiles()) > NAMED_FILES:
        return df.select(*keep, *[f(file).alias(c) for c, f in of.items()])
    listed = list_files(df.sparkSession, path).select(F.col("file").alias("__file"),
                                                      F.struct(*[f(F.col("file")).alias(c) for c, f in of.items()]).alias("__of"))
    rows = df.select(*keep, file.alias("__path")).join(F.broadcast(listed), F.col("__path") == F.col("__file"), "left")
    made = [F.when(F.col("__file").isNull(), f(F.col("__path"))).otherwise(F.col("__of")[c]).alias(c) for c, f in of.items()]
    return rows.select(*[c for c in rows.columns if not c.startswith("__")], *made)


def by_header(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Delivered files by their first line, read through the file system that holds them; empty files are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    out: dict[str, list[str]] = {}
    for f in sorted(files):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        codec, stream = codecs.getCodec(path), path.getFileSystem(conf).open(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            out.setdefault(line, []).append(f)
    return out


def named_columns(df: DataFrame, schema: T.StructType, required: list[str], keep_others: bool = False) -> list[Column]:
    """Text columns of a file with a header, selected by name and cast to ``schema``.

    A cell that does not parse is null.  A required name that the header lacks
    raises; any other absent column is null.  Names compare without case.
    """
    here = {c.strip().lower(): c for c in df.columns}
    absent = [c for c in required if c not in here]
    if absent:
        raise ValueError(f"the header lacks {absent}; it has {df.columns}")
    cols = [F.col(f"`{here[f.name]}`").try_cast(f.dataType).alias(f.name) if f.name in here
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    if keep_others:
        known = {f.name for f in schema.fields}
        cols += [F.col(f"`{c}`") for name, c in here.items() if name not in known]
    return cols


def read_csv_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType, required: list[str],
                     options: dict | None = None, more: dict | None = None, cells: bool = False) -> DataFrame:
    """CSV files read by the names in each file's own header, whatever their order.

    Files that share a header line are one scan.  ``cells`` adds the column
    ``_cells`` with the text of every cell that is not text by ``schema``.
    """
    def reader():
        r = spark.read.option("header", True)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r

    other = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in other])
    parts = []
    for files in by_header(spark, [r["file"] for r in list_files(spark, path).select("file").collect()]).values():
        text = reader().csv(files)
        kept = [*named_columns(text, schema, required),
                *([F.struct(*named_columns(text, as_text, [])).alias(CELLS)] if cells else [])]
        parts.append(with_path_columns(text, files, {PERIOD_COLUMN: period_from_path, **(more or {})}, kept))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, *([T.StructField(CELLS, as_text)] if cells else []),
                                                       *[T.StructField(c, T.StringType()) for c in [PERIOD_COLUMN, *(more or {})]]]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_extracts(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                  schema: T.StructType | None = None, options: dict | None = None, more: dict | None = None,
                  cells: bool = False) -> DataFrame:
    """Read every extract under ``path`` with a declared schema (no inference).

    Parquet extracts carry text as binary (``I94_RAW``); CSV extracts carry it
    as text (``I94_RAW_TEXT``) and are read by the names in their headers.
    ``source_period`` comes from each file's path: its ``source_period=``
    folder, else its name.  ``more`` names further text columns made from the path;
    ``cells`` keeps the text of CSV cells beside their values (``_cells``).
    """
    if fmt == "csv":
        return read_csv_by_name(spark, path, schema or I94_RAW_TEXT, REQUIRED_COLUMNS, options, more, cells)
    reader = spark.read.format(fmt).schema(schema or I94_RAW).option("recursiveFileLookup", True)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else path
    return with_path_columns(reader.load(paths), paths, {PERIOD_COLUMN: period_from_path, **(more or {})}, ["*"])


def write_lake(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Write extracts partitioned by period (dynamic overwrite: only the periods present)."""
    with open_files(df.sparkSession):
        (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(PERIOD_COLUMN).parquet(target))


def land_extracts(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
                  schema: T.StructType | None = None, options: dict | None = None,
                  with_profile: bool = False):
    """Land all extracts under ``source`` into the lake at ``target``; returns the lake table.

    ``with_profile=True`` also returns the batch's null profile
    ``(total_rows, {column: nulls})``, gathered as observed metrics by the
    landing write itself: the profile then needs no scan of its own.
    """
    df = read_extracts(spark, source, fmt, schema, options)
    return land_rows(df, target, with_profile)


def land_rows(df: DataFrame, target: str, with_profile: bool = False):
    """Write extracts that were read already; see :func:`land_extracts`."""
    spark = df.sparkSession
    if not with_profile:
        write_lake(df, target)
        return spark.read.parquet(target)
    from landfall.operators.profile import observe_nulls, observed_counts

    observed, obs = observe_nulls(df)
    write_lake(observed, target)
    return spark.read.parquet(target), observed_counts(obs)


def read_airports_csv(spark: SparkSession, path: str) -> DataFrame:
    """Airport CSV read by header name: the declared columns typed, all others kept as text.

    The text ``NA`` (North America, Namibia) is kept as text: only empty
    cells are null.
    """
    text = spark.read.option("header", True).option("nullValue", "").csv(path)
    return text.select(*named_columns(text, AIRPORTS, AIRPORTS.names, keep_others=True))


def land_airports(spark: SparkSession, df: DataFrame, target: str) -> DataFrame:
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
