"""Profile of the source files: inventory, schema and coverage of whole files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dotted paths whose presence is measured, the time fields among
# them, and the families of the core schema report.
FIELD_PATHS = (
    "id",
    "resourceType",
    "meta.profile",
    "subject.reference",
    "encounter.reference",
    "effectiveDateTime",
    "issued",
    "authoredOn",
    "period.start",
)
TIME_PATHS = ("effectiveDateTime", "issued", "authoredOn", "period.start")
CORE_FAMILIES = (
    "MimicPatient",
    "MimicEncounter",
    "MimicEncounterED",
    "MimicEncounterICU",
    "MimicObservationChartevents",
    "MimicObservationLabevents",
    "MimicObservationVitalSignsED",
    "MimicCondition",
    "MimicMedicationRequest",
)

_COVERAGE_SCHEMA = (
    "struct<id:string,resourceType:string,meta:struct<profile:string>,"
    "subject:struct<reference:string>,encounter:struct<reference:string>,"
    "effectiveDateTime:string,issued:string,authoredOn:string,"
    "period:struct<start:string>>"
)


def coverage_column(path: str) -> str:
    return "has_" + path.replace(".", "_").lower()


def is_present(text: Column) -> Column:
    return text.isNotNull() & ~text.isin("", "[]", "{}")


def with_facts(lines: DataFrame) -> DataFrame:
    """Lines with what a profile needs of each: id, type, first profile, top-level
    keys (``shape``) and, a bit for each measured path, which hold a value."""
    present = sum(
        (
            F.when(is_present(F.col(f"r.{path}")), 1 << i).otherwise(0)
            for i, path in enumerate(FIELD_PATHS)
        ),
        F.lit(0),
    )
    return lines.withColumn("r", F.from_json("value", _COVERAGE_SCHEMA)).select(
        *lines.columns,
        F.col("r.id").alias("resource_id"),
        F.col("r.resourceType").alias("resource_type"),
        F.get_json_object("r.meta.profile", "$[0]").alias("profile_url"),
        F.json_object_keys("value").alias("shape"),
        present.alias("present"),
    )


def file_profiles(resources: DataFrame) -> DataFrame:
    """One row per source file: everything the profile needs.

    ``resources`` carries ``source_file, value, line_id`` and, where they were landed
    with them, their facts and ``line_hash``; then no text is read. Row count, first
    row's type and profile, how many rows hold each top-level key and each measured
    path, and the digest of all payloads. Rows of one shape, type and profile are
    folded first, by numbers alone; files and keys are both folded from these, so no
    list of shapes is held.
    """
    known = resources if "present" in resources.columns else with_facts(resources)
    hashes = F.col("line_hash") if "line_hash" in resources.columns else F.xxhash64("value")
    covered = [coverage_column(path) for path in FIELD_PATHS]
    shapes = known.groupBy("source_file", "shape", "resource_type", "profile_url").agg(
        F.count("*").alias("n"),
        F.min("line_id").alias("first_id"),
        F.sum(hashes.cast("decimal(38,0)")).alias("digest"),
        *[
            F.count_if(F.col("present").bitwiseAND(1 << i) != 0).alias(name)
            for i, name in enumerate(covered)
        ],
    )
    first = F.min_by(F.struct("resource_type", "profile_url"), "first_id")
    files = shapes.groupBy("source_file").agg(
        F.sum("n").alias("row_count"),
        first.alias("first"),
        F.sum("digest").cast("string").alias("payload_digest"),
        *[F.sum(name).alias(name) for name in covered],
    )
    keys = (
        shapes.select("source_file", F.explode(F.array_distinct("shape")).alias("key"), "n")
        .groupBy("source_file", "key")
        .agg(F.sum("n").alias("n"))
        .groupBy("source_file")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("key_counts"))
    )
    counted = F.coalesce("key_counts", F.create_map().cast("map<string,bigint>"))
    return files.join(keys, "source_file", "left").select(
        "source_file",
        "row_count",
        F.col("first.resource_type").alias("resource_type"),
        F.col("first.profile_url").alias("profile_url"),
        F.array_sort(F.map_keys(counted)).alias("top_level_keys"),
        counted.alias("key_counts"),
        "payload_digest",
        *covered,
    )


def resource_inventory(profiles: DataFrame, files: DataFrame) -> DataFrame:
    """Rows per source file, with type and profile of the file's first row and the
    digest of its payloads; files without rows come from ``files``."""
    firsts = profiles.select(
        "source_file", "resource_type", "profile_url", "row_count", "payload_digest"
    )
    return (
        files.select("source_file", "resource_family")
        .join(firsts, "source_file", "left")
        .select(
            "source_file",
            "resource_family",
            "resource_type",
            "profile_url",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            "payload_digest",
        )
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_resources"),
    )


def sampled(numbered: DataFrame, sample_rows: int) -> DataFrame:
    """The first rows of every file (a sampling operator: the limit is its job)."""
    return numbered.filter(F.col("position") <= sample_rows).withColumnRenamed(
        "position", "line_id"
    )


def first_rows(resources: DataFrame, sample_rows: int) -> DataFrame:
    """The first resources of every file by their running id (a sampling operator).
    Only so many rows of a file per task reach the exchange."""
    place = Window.partitionBy("source_file").orderBy("line_id")
    ranked = resources.withColumn("_place", F.row_number().over(place))
    return ranked.filter(F.col("_place") <= sample_rows).drop("_place")


def schema_profile(profiles: DataFrame, files: DataFrame) -> DataFrame:
    """Keys and coverage of the profiled rows of every file, empty files too."""
    covered = [coverage_column(path) for path in FIELD_PATHS]
    joined = files.select("source_file", "resource_family").join(
        profiles.select(
            "source_file",
            F.col("row_count").alias("sampled_rows"),
            "top_level_keys",
            *covered,
        ),
        "source_file",
        "left",
    )
    return joined.select(
        "source_file",
        "resource_family",
        F.coalesce("top_level_keys", F.array().cast("array<string>")).alias(
            "top_level_keys"
        ),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sampled_rows", *covered)],
    )


def resource_type_summary(inventory: DataFrame) -> DataFrame:
    return (
        inventory.groupBy(
            F.coalesce("resource_type", F.lit("Unknown")).alias("resource_type")
        )
        .agg(F.count("*").alias("file_count"), F.sum("row_count").alias("row_count"))
        .orderBy("resource_type")
    )


def largest_files(inventory: DataFrame, limit: int = 8) -> DataFrame:
    return (
        inventory.select("source_file", "resource_type", "row_count")
        .orderBy(F.desc("row_count"), "source_file")
        .limit(limit)
    )


def core_schema_signals(profile: DataFrame) -> DataFrame:
    """Reference and timestamp coverage of the core families."""
    time_rows = sum((F.col(coverage_column(p)) for p in TIME_PATHS), F.lit(0))
    return profile.filter(F.col("resource_family").isin(*CORE_FAMILIES)).select(
        "source_file",
        "sampled_rows",
        F.array_join("top_level_keys", ", ").alias("top_level_keys"),
        F.col(coverage_column("subject.reference")).alias("subject_refs"),
        F.col(coverage_column("encounter.reference")).alias("encounter_refs"),
        time_rows.alias("timestamp_fields"),
    )


__all__ = [
    "core_schema_signals",
    "file_profiles",
    "first_rows",
    "inventory_totals",
    "largest_files",
    "resource_inventory",
    "resource_type_summary",
    "sampled",
    "schema_profile",
]
