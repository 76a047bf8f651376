"""Label text files (S02, S05): ``code = value`` per line, one file per label.

Read with ``spark.read.text`` over a folder; the label name is the stem of
the file name, taken from the hidden ``_metadata`` column, so one scan reads
every label file in parallel and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.labels import SEPARATOR, clean_value, label_code, label_value

def read_label_lines(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``(label, line)`` for every line of every label file under ``path``.

    The label is the stem of the file's name, or of its folder's for files
    that a Spark job wrote (``I94Port.txt/part-....txt``).
    """
    df = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path)
    file, folder = F.col("_metadata.file_name"), F.substring_index(F.col("_metadata.file_path"), "/", -2)
    name = F.when(file.startswith("part-"), F.substring_index(folder, "/", 1)).otherwise(file)
    return df.select(F.substring_index(name, ".", 1).alias("label"), F.col("value").alias("line"))


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """``(label, code, value)``: quotes deleted, split on ``=``.

    ``code`` keeps its padding (the per-label rules in
    ``operators.lookups`` normalise it); ``value`` is trimmed of spaces and
    tabs.  Lines without a separator (blank lines) carry no entry.
    """
    return (lines
            .where(F.instr(F.col("line"), SEPARATOR) > 0)
            .select("label",
                    label_code("line").alias("code"),
                    clean_value(label_value("line")).alias("value")))


def write_label_csv(parsed: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Land parsed labels as CSV with a ``code,value`` header, one folder per label."""
    (parsed.select("label", "code", "value")
     .write.mode(mode).partitionBy("label").option("header", True)
     # the CSV writer trims blanks unless told not to; codes keep their padding
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(target))


def scan_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read landed label CSV back as ``(label, code, value)`` strings.

    Columns are taken by the names in the header, as text; the typing rules
    live in ``operators.lookups``.  Leading and trailing blanks are kept as
    written.
    """
    return (spark.read.option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path)
            .select(F.col("label").cast("string").alias("label"), "code", "value"))
