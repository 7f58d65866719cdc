"""Bronze: one row per source resource, with lineage and the raw text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions.scalars import ascii_escaped
from wardlake.plans.registry import BRONZE_COLUMNS, BRONZE_SCHEMA, BRONZE_TABLE
from wardlake.sources.ndjson import (
    fail_on_first,
    file_starts,
    is_blank,
    is_resource,
    located_rejects,
    resource_family,
    scan_lines,
    source_files,
)
from wardlake.sources.staging import (
    TABLE_OPTIONS,
    exists,
    publish,
    remove,
    replacing,
    unsorted_writes,
)

#: Facts of a line that are landed beside it, besides those Bronze has.
FACTS = (("shape", T.ArrayType(T.StringType())), ("present", T.IntegerType()))
#: Gzipped bytes of a source file, some 25 MB of text, from which it is not rebalanced.
LARGE_FILE = 2 << 20
_ENVELOPE = "struct<resourceType:string,id:string,meta:struct<profile:array<string>>>"


@dataclass(frozen=True)
class BronzeWrite:
    """What one Bronze write did: where, how many resources, how many rejects."""

    path: str
    total_rows: int
    rejected_rows: int


def first_profile_url(raw_json: Column) -> Column:
    return F.get_json_object(raw_json, "$.meta.profile[0]")


def canonical_json(raw_json: Column) -> Column:
    """Key-sorted compact JSON with ASCII escapes (whole numbers lose ``.0``)."""
    return ascii_escaped(F.to_json(F.parse_json(raw_json)))


def bronze_rows(
    resources: DataFrame,
    dataset_name: str,
    dataset_version: str,
    ingested_at: str,
    canonical: bool = False,
    keep: tuple[str, ...] = (),
    parsed: bool = False,
) -> DataFrame:
    """Bronze rows from lines that hold a resource (``source_file, value``), with
    the ``keep`` columns of the lines behind them. Lines that are ``parsed`` bring
    their type, id and first profile along."""
    value = F.col("value")
    if not parsed:
        # One small parse for the envelope instead of one path lookup per column.
        resources = resources.withColumn("head", F.from_json(value, _ENVELOPE)).select(
            "source_file",
            "value",
            *keep,
            F.col("head.resourceType").alias("resource_type"),
            F.col("head.id").alias("resource_id"),
            F.get(F.col("head.meta.profile"), F.lit(0)).alias("profile_url"),
        )
    return resources.select(
        "resource_type",
        "resource_id",
        F.col("source_file"),
        resource_family(F.col("source_file")).alias("resource_family"),
        "profile_url",
        F.lit(dataset_name).alias("source_dataset_name"),
        F.lit(dataset_version).alias("source_dataset_version"),
        F.lit(ingested_at).alias("ingested_at"),
        (canonical_json(value) if canonical else value).alias("raw_json"),
        *keep,
    )


def source_bytes(spark: SparkSession, source_dir: str) -> int:
    """Total size of the source files, from the listing."""
    total = source_files(spark, source_dir).agg(F.sum("size_bytes").alias("total"))
    return total.first()["total"] or 0


def written_in_place(spark: SparkSession, source_dir: str) -> bool:
    """Whether the source files are large enough, on average, to be written as they lie."""
    mean = F.avg("size_bytes").alias("mean")
    return (source_files(spark, source_dir).agg(mean).first()["mean"] or 0) >= LARGE_FILE


def land(
    spark: SparkSession,
    source_dir: str,
    path: str,
    dataset_name: str,
    dataset_version: str,
    ingested_at: str,
    max_records_per_file: int = 0,
    canonical: bool = False,
    facts: Callable[[DataFrame], DataFrame] | None = None,
) -> BronzeWrite:
    """Inflate the sources once: every line, judged, with its running id in the file.

    The landing holds the Bronze rows by resource type below ``good=true`` and all
    other lines, blank ones too, below ``good=false``. Inventory, schema profile,
    rejects and Bronze come from it, so that no file is read twice. A line's hash is
    taken where the line is read; what is stored can be held against it. ``facts`` adds
    id, type, profile and further facts of each line, which are landed beside it.

    A gzip file is one task, so rows of small files are rebalanced by type before the
    write: by measured size, large types are split over several tasks and small ones
    share one, whatever the cluster, and a task writes few files. Files of some size are
    written by the task that inflates them, since rebalancing would shuffle the whole
    text. Row and reject counts are observed in the stage that writes, behind any
    exchange, where a task run again after a lost executor is not counted twice.
    """
    value, good = F.col("value"), F.col("good")
    judged = scan_lines(spark, source_dir).withColumn(
        "good", ~is_blank(value) & is_resource(value)
    )
    if canonical:
        text = F.when(good, canonical_json(value)).otherwise(value)
        judged = judged.withColumn("value", text)
    extra = ["line_id", "line_hash", "good"]
    judged = judged.withColumn("line_hash", F.xxhash64("value"))
    if facts:
        judged = facts(judged)
        extra += [name for name, _ in FACTS]
    rows = bronze_rows(
        judged,
        dataset_name,
        dataset_version,
        ingested_at,
        keep=tuple(extra),
        parsed=facts is not None,
    )
    if not written_in_place(spark, source_dir):
        rows = rows.hint("rebalance", "good", "resource_type")
    counts = Observation("landing")
    bad = ~good & ~is_blank(F.col("raw_json"))
    counted = rows.observe(
        counts, F.count_if(good).alias("good"), F.count_if(bad).alias("bad")
    )
    writer = counted.write.mode("overwrite").partitionBy("good", "resource_type")
    writer = writer.options(**TABLE_OPTIONS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with unsorted_writes(spark):
        writer.parquet(path)
    seen = counts.get
    return BronzeWrite(f"{path}/good=true", int(seen["good"]), int(seen["bad"]))


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a landing: whether they are good, ``source_file, value, line_id``,
    hash and facts (null where it was landed without)."""
    schema = T.StructType(list(BRONZE_SCHEMA.fields))
    schema = schema.add("line_id", "long").add("line_hash", "long").add("good", "boolean")
    for name, kind in FACTS:
        schema = schema.add(name, kind)
    return spark.read.schema(schema).parquet(path).select(
        "good",
        "source_file",
        F.col("raw_json").alias("value"),
        "line_id",
        "line_hash",
        "resource_type",
        "profile_url",
        *[name for name, _ in FACTS],
    )


def landed_rejects(lines: DataFrame) -> DataFrame:
    """The bad lines of a landing with their places; only these are parsed again."""
    bad = lines.filter(~F.col("good") & ~is_blank(F.col("value")))
    return located_rejects(bad, file_starts(lines))


def settle_rejects(
    lines: DataFrame, on_bad_line: str = "fail", rejects_path: str | None = None
) -> None:
    """Fail for the first bad line of a landing, or set the bad lines aside."""
    if on_bad_line not in ("fail", "quarantine"):
        raise ValueError(f"Unknown bad-line mode: {on_bad_line}")
    rejects = landed_rejects(lines)
    if on_bad_line == "fail":
        fail_on_first(rejects)
    elif rejects_path:
        with replacing(lines.sparkSession, rejects_path) as ready:
            rejects.write.parquet(ready)


def publish_bronze(spark: SparkSession, landing: str, path: str) -> None:
    """Put the good rows of a landing in the place of Bronze."""
    if not exists(spark, f"{landing}/good=true"):
        empty = spark.createDataFrame([], BRONZE_SCHEMA).drop("resource_type")
        empty.write.parquet(f"{landing}/good=true")
    publish(spark, f"{landing}/good=true", path)


def write_bronze(
    spark: SparkSession,
    source_dir: str,
    path: str,
    dataset_name: str,
    dataset_version: str,
    ingested_at: str,
    max_records_per_file: int = 0,
    canonical: bool = False,
    on_bad_line: str = "fail",
    rejects_path: str | None = None,
) -> BronzeWrite:
    """Scan the sources once and replace Bronze, split by resource type.

    The rows are written beside Bronze and take its place at the end. A bad line
    fails the run and leaves the Bronze there was, or goes to ``rejects_path`` when
    ``on_bad_line`` is ``"quarantine"``.
    """
    if on_bad_line not in ("fail", "quarantine"):
        raise ValueError(f"Unknown bad-line mode: {on_bad_line}")
    landing = f"{path}-landing-{uuid.uuid4().hex}"
    try:
        written = land(
            spark,
            source_dir,
            landing,
            dataset_name,
            dataset_version,
            ingested_at,
            max_records_per_file,
            canonical,
        )
        if written.rejected_rows:
            settle_rejects(landed_lines(spark, landing), on_bad_line, rejects_path)
        publish_bronze(spark, landing, path)
    finally:
        remove(spark, landing)
    return replace(written, path=path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze in its nine-column layout; the type filter prunes directories."""
    return spark.read.schema(BRONZE_SCHEMA).parquet(path).select(*BRONZE_COLUMNS)


def bronze_records(bronze: DataFrame, resource_type: str) -> DataFrame:
    """The eight columns Silver needs of one resource type."""
    return bronze.filter(F.col("resource_type") == resource_type).select(
        *[name for name in BRONZE_COLUMNS if name != "resource_type"]
    )


def bronze_manifest(
    inventory: DataFrame,
    write: BronzeWrite,
    dataset_name: str,
    dataset_version: str,
    part_files: DataFrame,
) -> DataFrame:
    """One row per source file: the rows Bronze must hold for it.

    ``part_files`` lists the written files; its count is a driver-side number.
    """
    return inventory.select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(dataset_version).alias("dataset_version"),
        F.lit(BRONZE_TABLE).alias("table_name"),
        F.lit(write.total_rows).cast("bigint").alias("total_rows"),
        F.lit(part_files.count()).cast("bigint").alias("part_files"),
        "source_file",
        F.col("row_count").alias("expected_rows"),
        *(["payload_digest"] if "payload_digest" in inventory.columns else []),
    )


def payload_digest(hashes: Column) -> Column:
    """Digest of a bag of payloads from their hashes: order and split do not matter."""
    return F.sum(hashes.cast("decimal(38,0)")).cast("string")


def bronze_file_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_file").agg(F.count("*").alias("row_count"))


def bronze_comparison(
    manifest: DataFrame, bronze: DataFrame, empty_files_fail: bool = True
) -> DataFrame:
    """Expected and actual rows per source file, from both directions.

    A source file without rows cannot appear in Bronze, so it counts as different
    unless the caller allows it. Where the manifest has the digest of the payloads as
    they were read, those stored must have the same one.
    """
    digested = "payload_digest" in manifest.columns
    actual = bronze.groupBy("source_file").agg(
        F.count("*").alias("actual_rows"),
        *([payload_digest(F.xxhash64("raw_json")).alias("_stored")] if digested else []),
    )
    expected = ["source_file", "expected_rows", "total_rows"]
    both = manifest.select(*expected, *(["payload_digest"] if digested else [])).join(
        actual, "source_file", "full_outer"
    )
    if empty_files_fail:
        differs = ~F.col("expected_rows").eqNullSafe(F.col("actual_rows"))
    else:
        differs = F.coalesce("expected_rows", F.lit(0)) != F.coalesce(
            "actual_rows", F.lit(0)
        )
    if digested:
        differs |= ~F.col("payload_digest").eqNullSafe(F.col("_stored"))
    columns = [*expected, "actual_rows", "differs"]
    return both.withColumn("differs", differs).select(*columns)


def bronze_mismatches(
    manifest: DataFrame, bronze: DataFrame, empty_files_fail: bool = True
) -> DataFrame:
    """Source files whose Bronze rows differ from the manifest."""
    compared = bronze_comparison(manifest, bronze, empty_files_fail)
    return compared.filter("differs").select(
        "source_file", "expected_rows", "actual_rows"
    )


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """Part files below a written table, with their sizes (content unread)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("size_bytes"))
    )


__all__ = [
    "BronzeWrite",
    "bronze_comparison",
    "bronze_file_counts",
    "bronze_manifest",
    "bronze_mismatches",
    "bronze_records",
    "bronze_rows",
    "canonical_json",
    "first_profile_url",
    "land",
    "landed_lines",
    "landed_rejects",
    "payload_digest",
    "publish_bronze",
    "read_bronze",
    "settle_rejects",
    "source_files",
    "write_bronze",
    "written_files",
]
