"""Scan of gzipped NDJSON resource files: lines, valid resources, rejects."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_PATTERN = "*.ndjson.gz"
# A family too large for one gzip file may come in numbered shards
# (``Family.part-0.ndjson.gz``); the shard number is not part of the family. The
# dot and the word keep families apart whose names end in a number.
FAMILY_SUFFIX = r"(\.part-\d+)?\.ndjson\.gz$"
PACKING = "spark.sql.files.minPartitionNum"


class SourceReadError(ValueError):
    """A source line is not a JSON object."""


def source_files(spark: SparkSession, source_dir: str) -> DataFrame:
    """One row per source file (name, family, bytes) in order of the names, without
    reading content.

    A missing directory is an error; other files are left out.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", FILE_PATTERN)
        .load(source_dir)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return listing.select(
        name.alias("source_file"),
        resource_family(name).alias("resource_family"),
        F.col("length").alias("size_bytes"),
    ).orderBy("source_file")


@contextmanager
def pinned_file_packing(spark: SparkSession) -> Iterator[None]:
    """Fix how files are packed into tasks while a job runs.

    Two scans of the same files must number lines alike. The packing follows the
    core count, which may grow between the scans while executors join; a value
    the session already sets is kept.
    """
    own = spark.conf.get(PACKING, None)
    if own is None:
        spark.conf.set(PACKING, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(PACKING)


def scan_lines(spark: SparkSession, source_dir: str) -> DataFrame:
    """Every physical line with its file and a running id.

    A gzip file cannot be split, so a file lies in one task and its ids are
    consecutive in file order. Nothing here may shuffle before the id is taken.
    """
    return (
        spark.read.option("pathGlobFilter", FILE_PATTERN)
        .text(source_dir)
        .select(
            F.col("_metadata.file_name").alias("source_file"),
            F.col("value"),
            F.monotonically_increasing_id().alias("line_id"),
        )
    )


def resource_family(source_file: Column) -> Column:
    return F.regexp_replace(source_file, FAMILY_SUFFIX, "")


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"(?U)\S")


def opens_object(line: Column) -> Column:
    return line.rlike(r'^\s*\{\s*["}]')


def is_single_value(line: Column) -> Column:
    """True when the line holds exactly one well-formed JSON value.

    Wrapping the line in a list makes text after the value an error too.
    """
    wrapped = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    return F.coalesce(wrapped == 1, F.lit(False))


def is_resource(line: Column) -> Column:
    return opens_object(line) & is_single_value(line)


def scan_resources(lines: DataFrame, validate: bool = True) -> DataFrame:
    """Lines that hold a resource; blank and bad lines are left out.

    Without ``validate`` every line that is not blank counts as a resource: for
    runs in which a bad line fails the Bronze write anyway.
    """
    value = F.col("value")
    kept = lines.filter(~is_blank(value))
    return kept.filter(is_resource(value)) if validate else kept


def file_starts(lines: DataFrame) -> DataFrame:
    """First id and number of lines per file: one row of some hundred bytes each."""
    return lines.groupBy("source_file").agg(
        F.min("line_id").alias("first_id"), F.count("*").alias("row_count")
    )


def with_starts(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with their file's first id and row count.

    Joined on a derived key, so that both sides are exchanged for the join alone:
    a file with very many lines can then be split at run time.
    """
    key = F.concat(F.col("source_file"), F.lit("/"))
    return lines.withColumn("_file", key).join(
        starts.select(key.alias("_file"), "first_id", "row_count"), "_file"
    )


def numbered_resources(
    spark: SparkSession, source_dir: str, validate: bool = True
) -> DataFrame:
    """Resources with their 1-based position in the file and the file's row count.

    Only samples by position need it. The position comes from a running id taken
    after the filter, less the first id of the file.
    """
    running = scan_resources(scan_lines(spark, source_dir), validate).withColumn(
        "line_id", F.monotonically_increasing_id()
    )
    return with_starts(running, file_starts(running)).select(
        "source_file",
        "value",
        (F.col("line_id") - F.col("first_id") + 1).alias("position"),
        "row_count",
    )


def located_rejects(bad: DataFrame, starts: DataFrame) -> DataFrame:
    """File name, 1-based physical line number and reason of bad lines
    (``source_file, value, line_id``)."""
    value = F.col("value")
    reason = F.when(is_single_value(value), F.lit("not_an_object")).otherwise(
        F.lit("malformed_json")
    )
    return with_starts(bad, starts).select(
        "source_file",
        (F.col("line_id") - F.col("first_id") + 1).alias("line_number"),
        reason.alias("reason"),
        value.alias("line"),
    )


def scan_rejects(lines: DataFrame) -> DataFrame:
    """Bad lines with file name, 1-based physical line number and reason."""
    value = F.col("value")
    bad = lines.filter(~is_blank(value) & ~is_resource(value))
    return located_rejects(bad, file_starts(lines))


def fail_on_first(rejects: DataFrame) -> None:
    """Raise for the first reject, naming its file and line number."""
    first = rejects.orderBy("source_file", "line_number").take(1)
    if first:
        row = first[0]
        what = (
            "Expected JSON object"
            if row["reason"] == "not_an_object"
            else "Invalid JSON"
        )
        raise SourceReadError(
            f"{what} in {row['source_file']} at line {row['line_number']}"
        )


def fail_on_rejects(lines: DataFrame) -> None:
    """Raise for the first bad line, naming its file and line number."""
    fail_on_first(scan_rejects(lines))
