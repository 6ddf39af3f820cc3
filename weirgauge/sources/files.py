"""Delimited-text sources: strict and permissive scans, inventory, header audit."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ContractError, FlowContract
from ..operators.ordering import first_per_group
from ..session import scratch

#: Files whose first rows one job reads, and bytes of a split that no file exceeds.
FILES_PER_JOB = 256
WHOLE_FILE = 1 << 50


def write_csv(df: DataFrame, path: str) -> str:
    """Write text cells exactly as they are: blanks kept, NULL as an empty field."""
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)
    return path


def strict_scan(spark: SparkSession, path: str, contract: FlowContract) -> DataFrame:
    """All-text scan that fails on a wrong header or a malformed row."""
    options = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}
    return spark.read.options(**options).schema(contract.raw_schema).csv(path)


def inferred_scan(spark: SparkSession, path: str) -> DataFrame:
    """Scan with types guessed from the data; for profiling only, reads twice."""
    return spark.read.options(header=True, inferSchema=True, mode="FAILFAST").csv(path)


def label_scan(spark: SparkSession, paths, contract: FlowContract) -> DataFrame:
    """Only the label, from many files; the reader parses just that column."""
    reader = spark.read.options(header=True, mode="PERMISSIVE").schema(contract.raw_schema)
    label = F.col(f"`{contract.label}`")
    return reader.csv(paths).select(F.trim(label).alias(contract.label))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of every ``*.csv`` below a folder, with their file and block."""
    reader = spark.read.options(pathGlobFilter="*.csv", recursiveFileLookup=True)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def first_lines(lines: DataFrame, count: int) -> DataFrame:
    """The first lines of every file of ``csv_lines``, numbered from 1; every line is looked at.

    A split of a file is read by one task in order, so a line's number among the
    lines of its split follows from the first number of the split, which a small
    aggregation finds.  Only the first lines of the splits are ranked.
    """
    lines = lines.withColumn("line", F.monotonically_increasing_id())
    starts = lines.groupBy("file", "block").agg(F.min("line").alias("start"))
    near = lines.join(F.broadcast(starts), ["file", "block"]).where(F.col("line") - F.col("start") < count)
    return first_per_group(near.drop("start"), "file", ("block", "line"), count)


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files of a folder and their sizes; a folder without any is an error.

    Listing uses the binary-file source with its content column pruned, so the
    files are not read, and a folder of any length is listed by Spark.
    """
    reader = spark.read.format("binaryFile").options(
        pathGlobFilter="*.csv", recursiveFileLookup=True
    )
    files = reader.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    if files.isEmpty():
        raise ContractError(f"no CSV files in {path}")
    return files


def _whole_files(spark: SparkSession) -> SparkSession:
    """A session in which a file is one split, however large."""
    side = spark.newSession()
    side.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    side.conf.set("spark.sql.files.maxPartitionBytes", str(WHOLE_FILE))
    return side


def head(rows: DataFrame, count: int) -> DataFrame:
    """The first rows of one file that is one split, numbered from 1.

    The limit stops the task, which closes the file: no more of it is read.
    """
    return rows.limit(count).withColumn("position", F.monotonically_increasing_id() + 1)


def heads(spark: SparkSession, path: str, count: int, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The first rows of every CSV file below a folder, as a stored table.

    One job reads FILES_PER_JOB files side by side.  The driver holds file names.
    """
    side, out = _whole_files(spark), scratch(spark, "heads")
    names = [r.file for r in inventory(spark, path).select("file").collect()]
    for first in range(0, len(names), FILES_PER_JOB):
        parts = [head(read(side, name), count) for name in names[first : first + FILES_PER_JOB]]
        reduce(DataFrame.unionByName, parts).write.mode("append").parquet(out)
    return spark.read.parquet(out)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """First line of every file; of each file only its beginning is read."""

    def lines(side: SparkSession, name: str) -> DataFrame:
        return side.read.text(name).select(F.col("_metadata.file_path").alias("file"), "value")

    first = heads(spark, path, 1, lines)
    return first.select("file", F.regexp_replace(F.col("value"), "^\ufeff", "").alias("header"))


def audit_headers(spark: SparkSession, path: str, required) -> DataFrame:
    """Status of each file's header: duplicate, missing, order mismatch or ok.

    The expected header is that of the alphabetically first file.
    """
    found = headers(spark, path)
    expected = found.agg(F.min_by("header", "file").alias("h")).scalar()
    # Commas inside quotes belong to a name; the quotes around it do not.
    cut = F.split(F.col("header"), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    names = F.transform(cut, lambda n: F.replace(F.regexp_replace(n, '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))
    wanted = F.array(*[F.lit(n) for n in required])
    return found.select(
        "file",
        "header",
        F.when(F.size(F.array_distinct(names)) < F.size(names), "duplicate_column")
        .when(F.size(F.array_except(wanted, names)) > 0, "missing_column")
        .when(F.col("header") != expected, "header_mismatch")
        .otherwise("ok")
        .alias("status"),
    )


def sample_per_file(spark: SparkSession, path: str, contract: FlowContract, rows: int) -> DataFrame:
    """The first rows of every file, read strictly so that a short row among them fails.

    Of each file only its beginning is read.
    """
    if rows < 1:
        raise ContractError("rows per file must be positive")

    def lines(side: SparkSession, name: str) -> DataFrame:
        return strict_scan(side, name, contract).select("*", F.col("_metadata.file_path").alias("file"))

    return heads(spark, path, rows, lines)
