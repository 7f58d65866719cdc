"""Registered queries: one per operator, over the star-schema test tables.

Each entry takes (session, table folder) and returns a DataFrame. Expected
results are in :mod:`wardlake.harness.oracles` under the same names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.functions import fhir
from wardlake.functions.scalars import number_text, reference_tail, stable_key, wall_clock
from wardlake.harness import testbed
from wardlake.harness.stage import RESOURCE_TYPES, Lake, lake
from wardlake.operators import (
    gold,
    marts,
    privacy,
    profiling,
    quality,
    relationships,
    silver,
    silver_checks,
)
from wardlake.plans.job import run_pipeline
from wardlake.plans.registry import SILVER_TABLES
from wardlake.sources import bronze, ndjson, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Flat table whose rows a layer table has, for the check of known row counts.
COUNTED_AS = {
    "silver_patient": "customer",
    "silver_encounter": "orders",
    "gold_encounter_summary": "orders",
}
# One expectation is wrong on purpose.
WRONG_COUNTS = {"silver_procedure": 1}


def known_counts(k: Lake) -> dict[str, int]:
    """Expected row counts of the folder at hand, from its flat tables."""
    counts = {
        name: testbed.table(k.spark, k.sf_dir, source).count()
        for name, source in COUNTED_AS.items()
    }
    return {**counts, **WRONG_COUNTS}


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


def on_lake(name: str) -> Callable[[Callable[[Lake], DataFrame]], Callable]:
    """Register a query that works on the written layer tables."""

    def add(build: Callable[[Lake], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: build(lake(spark, sf_dir))
        return build

    return add


def fresh(place: Lake, label: str) -> str:
    return f"{place.root}/{label}-{uuid.uuid4().hex}"


# --- sources and sinks ----------------------------------------------------


@on_lake("src_1_source_files")
def _(k: Lake) -> DataFrame:
    """Families in the order in which their files are listed."""
    listed = ndjson.source_files(k.spark, k.landing()).withColumn(
        "place", F.monotonically_increasing_id()
    )
    first = (
        listed.filter("size_bytes > 0").groupBy("resource_family").agg(F.min("place"))
    )
    order = Window.orderBy("min(place)")
    return first.select("resource_family", F.row_number().over(order).alias("place"))


@on_lake("src_2_ndjson_scan")
def _(k: Lake) -> DataFrame:
    found = ndjson.scan_resources(ndjson.scan_lines(k.spark, k.landing()))
    family = ndjson.resource_family(F.col("source_file")).alias("resource_family")
    return found.groupBy(family).agg(F.count("*").alias("row_count"))


@on_lake("src_3_rejected_lines")
def _(k: Lake) -> DataFrame:
    """Encounter lines landed in order of their keys, some of them cut short,
    wrapped in a list or blanked; scanned from the compressed text."""
    key = F.substring("resource_id", 3, 20).cast("bigint")
    value = F.col("raw_json")
    spoiled = (
        F.when(key % 983 == 0, F.lit("   "))
        .when(key % 991 == 0, F.concat(F.lit("["), value, F.lit("]")))
        .when(key % 997 == 0, F.substr(value, F.lit(1), F.lit(40)))
        .when(key % 1009 == 0, F.concat(value, F.lit(" trailing")))
        .otherwise(value)
    )
    lines = k.bronze(["Encounter"]).select(
        "source_file", spoiled.alias("value"), key.alias("key")
    )
    folder = k.landed("spoiled", [lines], order="key")
    found = ndjson.scan_rejects(ndjson.scan_lines(k.spark, folder))
    return found.select("source_file", "line_number", "reason")


@on_lake("src_4_resource_family")
def _(k: Lake) -> DataFrame:
    rows = k.bronze().select(
        "source_file", ndjson.resource_family(F.col("source_file")).alias("family")
    )
    return rows.groupBy("source_file", "family").agg(F.count("*").alias("row_count"))


@on_lake("src_5_first_profile_url")
def _(k: Lake) -> DataFrame:
    url = bronze.first_profile_url(F.col("raw_json")).alias("profile_url")
    rows = k.bronze().select("resource_type", url)
    return rows.groupBy("resource_type", "profile_url").agg(
        F.count("*").alias("row_count")
    )


@query("src_6_canonical_json")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.to_json(F.struct("text", "source", "n_chars", "lang", "doc_id"))
    return testbed.table(spark, sf_dir, "documents").select(
        "doc_id", bronze.canonical_json(raw).alias("canonical_json")
    )


@query("src_7_bronze_rows")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [testbed.bronze_of(spark, sf_dir, kind) for kind in RESOURCE_TYPES]
    return tables.union_all(rows).drop("raw_json")


@on_lake("src_8_bronze_write")
def _(k: Lake) -> DataFrame:
    path = fresh(k, "bronze")
    done = bronze.write_bronze(
        k.spark,
        k.landing(),
        path,
        testbed.DATASET_NAME,
        testbed.DATASET_VERSION,
        testbed.INGESTED_AT,
        max_records_per_file=50_000,
    )
    counts = bronze.read_bronze(k.spark, path).groupBy("resource_type")
    return counts.agg(F.count("*").alias("row_count")).withColumn(
        "total_rows", F.lit(done.total_rows).cast("bigint")
    )


@on_lake("src_9_bronze_by_type")
def _(k: Lake) -> DataFrame:
    return bronze.bronze_records(k.bronze(), "Encounter").drop("raw_json")


@on_lake("src_10_table_scan")
def _(k: Lake) -> DataFrame:
    return k.silver("encounter").filter("status = 'finished'").select(
        "encounter_id", "class_code"
    )


@on_lake("src_11_silver_write")
def _(k: Lake) -> DataFrame:
    root = fresh(k, "silver")
    built = silver.build_silver("encounter", k.bronze(["Encounter"]))
    tables.write_silver(built, root, "encounter", max_records=50_000)
    return tables.read_silver(k.spark, root, "encounter")


@on_lake("src_12_gold_write")
def _(k: Lake) -> DataFrame:
    root = fresh(k, "gold")
    inputs = k.silver_tables(["procedure", "encounter"])
    built = gold.build_gold("procedure_summary", inputs)
    tables.write_gold(built, root, "procedure_summary")
    return tables.read_gold(k.spark, root, "procedure_summary")


def managed_patients(k: Lake) -> str:
    """Patient as a catalog table in a schema below the shared folder."""
    schema = f"wardlake_{k.root[-8:]}"
    k.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{k.root}/{schema}'")
    tables.save_managed(k.silver("patient"), f"{schema}.patient")
    return schema


@on_lake("src_13_managed_table")
def _(k: Lake) -> DataFrame:
    return k.spark.table(f"{managed_patients(k)}.patient")


@on_lake("src_14_three_part_name")
def _(k: Lake) -> DataFrame:
    name = tables.table_name("spark_catalog", managed_patients(k), "patient")
    return k.spark.table(name).groupBy("gender").agg(F.count("*").alias("row_count"))


@on_lake("src_15_json_artifact")
def _(k: Lake) -> DataFrame:
    path = fresh(k, "relationship_metrics")
    tables.write_json_rows(metrics(k), path)
    schema = "metric string, kind string, table_name string, value bigint"
    return k.spark.read.schema(schema).json(path)


# --- profiling and Bronze checks ------------------------------------------


def per_family(df: DataFrame, *sums: str) -> DataFrame:
    """Fold per-file rows to families: a family may come in several files."""
    family = ndjson.resource_family(F.col("source_file"))
    return df.groupBy(family.alias("source_file")).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[
            F.min(c).alias(c)
            for c in ("resource_type", "resource_family")
            if c in df.columns
        ],
    )


def profiles(k: Lake) -> DataFrame:
    """The fold of every landed file, as the job takes it."""
    lines = ndjson.scan_lines(k.spark, k.landing())
    return profiling.file_profiles(ndjson.scan_resources(lines))


def inventory(k: Lake) -> DataFrame:
    files = ndjson.source_files(k.spark, k.landing())
    return profiling.resource_inventory(profiles(k), files)


def family_inventory(k: Lake) -> DataFrame:
    return per_family(inventory(k), "row_count")


def schema(k: Lake) -> DataFrame:
    files = ndjson.source_files(k.spark, k.landing())
    return profiling.schema_profile(profiles(k), files)


def family_profile(k: Lake) -> DataFrame:
    counts = ["sampled_rows", *map(profiling.coverage_column, profiling.FIELD_PATHS)]
    return per_family(schema(k), *counts)


@on_lake("prf_1_resource_inventory")
def _(k: Lake) -> DataFrame:
    """Families with their first profile; those that also have rows without one are
    given none here, since the first row of a file may be such a row."""
    rows = inventory(k).join(
        profiles(k).select("source_file", "has_meta_profile"), "source_file"
    )
    always = F.sum("has_meta_profile") == F.sum("row_count")
    return rows.groupBy("resource_family").agg(
        F.min("resource_type").alias("resource_type"),
        F.when(always, F.min("profile_url")).alias("profile_url"),
        F.sum("row_count").alias("row_count"),
    )


@on_lake("prf_2_inventory_totals")
def _(k: Lake) -> DataFrame:
    return profiling.inventory_totals(family_inventory(k))


@on_lake("prf_3_top_level_keys")
def _(k: Lake) -> DataFrame:
    return (
        schema(k)
        .select("resource_family", F.explode("top_level_keys").alias("key"))
        .distinct()
    )


@on_lake("prf_4_field_coverage")
def _(k: Lake) -> DataFrame:
    return family_profile(k).drop("source_file")


@on_lake("prf_5_resource_type_summary")
def _(k: Lake) -> DataFrame:
    return profiling.resource_type_summary(family_inventory(k))


@on_lake("prf_6_largest_files")
def _(k: Lake) -> DataFrame:
    return profiling.largest_files(family_inventory(k))


@on_lake("prf_7_core_schema_signals")
def _(k: Lake) -> DataFrame:
    no_keys = F.array().cast("array<string>")
    profile = family_profile(k).withColumn("top_level_keys", no_keys)
    return profiling.core_schema_signals(profile).drop("top_level_keys")


def landed_bronze(k: Lake) -> tuple[DataFrame, DataFrame]:
    """Manifest and Bronze of one write from the landed files."""
    path = fresh(k, "bronze")
    written = bronze.write_bronze(
        k.spark,
        k.landing(),
        path,
        testbed.DATASET_NAME,
        testbed.DATASET_VERSION,
        testbed.INGESTED_AT,
    )
    manifest = bronze.bronze_manifest(
        inventory(k),
        written,
        testbed.DATASET_NAME,
        testbed.DATASET_VERSION,
        bronze.written_files(k.spark, path),
    )
    return manifest, bronze.read_bronze(k.spark, path)


@on_lake("brz_1_manifest")
def _(k: Lake) -> DataFrame:
    manifest, _ = landed_bronze(k)
    family = ndjson.resource_family(F.col("source_file")).alias("resource_family")
    return manifest.groupBy(
        "dataset_name", "dataset_version", "table_name", "total_rows", family
    ).agg(F.sum("expected_rows").alias("expected_rows"))


@on_lake("brz_2_rows_per_file")
def _(k: Lake) -> DataFrame:
    return bronze.bronze_file_counts(k.bronze())


@on_lake("brz_3_bronze_validation")
def _(k: Lake) -> DataFrame:
    manifest, rows = landed_bronze(k)
    return bronze.bronze_comparison(manifest, rows).agg(
        F.count_if("differs").alias("differing_files"),
        F.sum("actual_rows").alias("actual_rows"),
        F.max("total_rows").alias("manifest_rows"),
    )


@on_lake("brz_3_empty_file")
def _(k: Lake) -> DataFrame:
    """A source file without rows differs, unless that is allowed."""
    manifest, rows = landed_bronze(k)
    empty = manifest.limit(1).select(
        *[
            F.lit("MimicEmpty.ndjson.gz").alias(c)
            if c == "source_file"
            else F.lit(0).cast("bigint").alias(c)
            if c == "expected_rows"
            else F.lit(None).cast("string").alias(c)
            if c == "payload_digest"
            else F.col(c)
            for c in manifest.columns
        ]
    )
    whole = manifest.unionByName(empty)
    return tables.union_all(
        [
            bronze.bronze_mismatches(whole, rows, empty_files_fail=strict).agg(
                F.lit(strict).alias("strict"),
                F.count("*").alias("differing_files"),
                F.max("source_file").alias("source_file"),
            )
            for strict in (True, False)
        ]
    )


# --- field extraction -----------------------------------------------------

R = silver.R


def extraction(name: str, resource_type: str, key: str):
    """Register a query that applies extraction rules to every resource of a type.

    The decorated function returns the extracted columns by name.
    """

    def add(columns: Callable[[], dict]) -> Callable:
        def build(k: Lake) -> DataFrame:
            rows = silver.parsed(k.bronze([resource_type]), resource_type)
            return rows.select(
                R["id"].alias(key), *[c.alias(n) for n, c in columns().items()]
            )

        on_lake(name)(build)
        return columns

    return add


def fields(struct, *names: str) -> dict:
    return {name: struct[name] for name in names}


@extraction("ext_1_scalar_text", "Encounter", "encounter_id")
def _():
    return {"status": R["status"]}


@extraction("ext_2_reference_tail", "MedicationRequest", "medication_request_id")
def _():
    reference = F.get_json_object(R["medicationReference"], "$.reference")
    return {"medication_id": reference_tail(reference)}


@extraction("ext_3_reference_node", "Encounter", "encounter_id")
def _():
    return {"patient_id": fhir.reference_id(R["subject"])}


@extraction("ext_4_reference_list", "MedicationDispense", "medication_dispense_id")
def _():
    ids = fhir.reference_ids(R["authorizingPrescription"])
    return {"request_ids": F.array_join(ids, ",")}


@extraction("ext_5_first_identifier", "Patient", "patient_id")
def _():
    return {"source_patient_identifier": fhir.first_identifier_value(R["identifier"])}


@extraction("ext_6_first_family_name", "Patient", "patient_id")
def _():
    return {"synthetic_patient_name": fhir.first_family_name(R["name"])}


@extraction("ext_7_first_coding", "Patient", "patient_id")
def _():
    return {"marital_status_code": fhir.first_coding(R["maritalStatus"])["code"]}


@extraction("ext_8_first_coding_in_list", "Observation", "observation_id")
def _():
    return {"category_code": fhir.first_coding_in_list(R["category"])["code"]}


def code_fields() -> dict:
    coding = fhir.coding_fields(fhir.first_coding(R["code"]))
    return {
        "code": coding["code"],
        "code_system": coding["system"],
        "display": coding["display"],
    }


extraction("ext_9_coding_fields", "Observation", "observation_id")(code_fields)
extraction("ext_12_coding_without_fallback", "Condition", "condition_id")(code_fields)


@extraction("ext_10_concept_text", "MedicationDispense", "medication_dispense_id")
def _():
    return {"medication_text": R["medicationCodeableConcept"]["text"]}


@extraction("ext_11_concept_fields", "Procedure", "procedure_id")
def _():
    concept = fhir.concept_fields(R["code"])
    return {
        "procedure_code": concept["code"],
        "procedure_code_system": concept["system"],
        "procedure_display": concept["display"],
    }


@extraction("ext_13_extension_by_url", "Patient", "patient_id")
def _():
    return {
        name: fhir.extension_by_url(R["extension"], url).isNotNull()
        for name, url in (
            ("has_race", fhir.RACE_URL),
            ("has_birth_sex", fhir.BIRTH_SEX_URL),
        )
    }


@extraction("ext_14_extension_text", "Patient", "patient_id")
def _():
    return {
        name: fhir.extension_text(fhir.extension_by_url(R["extension"], url))
        for name, url in (
            ("race", fhir.RACE_URL),
            ("ethnicity", fhir.ETHNICITY_URL),
            ("birth_sex", fhir.BIRTH_SEX_URL),
        )
    }


@extraction("ext_15_quantity", "Observation", "observation_id")
def _():
    return fields(fhir.quantity_fields(R["valueQuantity"]), "value", "unit")


@extraction("ext_16_period", "Encounter", "encounter_id")
def _():
    period = fhir.period_fields(R["period"])
    return {"start_datetime": period["start"], "end_datetime": period["end"]}


@extraction(
    "ext_17_effective_window",
    "MedicationAdministration",
    "medication_administration_id",
)
def _():
    window = fhir.effective_window(R)
    return {
        "effective_start_datetime": window["start"],
        "effective_end_datetime": window["end"],
    }


@extraction("ext_18_dosage_dose", "MedicationRequest", "medication_request_id")
def _():
    dose = fhir.dosage_dose(fhir.first_dosage(R["dosageInstruction"]))
    return {"dose_value": dose["value"], "dose_unit": dose["unit"]}


@extraction("ext_19_dosage_summary", "MedicationRequest", "medication_request_id")
def _():
    return fields(
        fhir.dosage_summary(fhir.first_dosage(R["dosageInstruction"])),
        "route_code",
        "route_display",
        "dose_value",
        "dose_unit",
        "frequency",
        "period",
        "period_unit",
    )


@extraction(
    "ext_20_administration_dosage",
    "MedicationAdministration",
    "medication_administration_id",
)
def _():
    return fields(
        fhir.administration_dosage(R["dosage"]),
        "dose_value",
        "dose_unit",
        "method_code",
        "method_display",
    )


@extraction("ext_21_list_length", "Medication", "medication_id")
def _():
    return {
        "identifier_count": fhir.list_length(R["identifier"]),
        "ingredient_count": fhir.list_length(R["ingredient"]),
    }


@extraction("ext_22_identifier_by_system", "Medication", "medication_id")
def _():
    system = fhir.MEDICATION_NAME_SYSTEM
    return {"medication_name": fhir.identifier_value_for(R["identifier"], system)}


@extraction("ext_23_observation_value", "Observation", "observation_id")
def _():
    return fields(fhir.observation_value(R), "value_type", "value", "unit")


@on_lake("ext_24_source_system")
def _(k: Lake) -> DataFrame:
    rules = {
        "MedicationAdministration": (fhir.ADMINISTRATION_FAMILIES, "hospital"),
        "MedicationDispense": (fhir.DISPENSE_FAMILIES, "inpatient"),
        "Procedure": (fhir.PROCEDURE_FAMILIES, "hospital"),
    }
    system = F.lit(None).cast("string")
    for kind, (families, default) in rules.items():
        label = fhir.source_system(F.col("resource_family"), families, default)
        system = F.when(F.col("resource_type") == kind, label).otherwise(system)
    return (
        k.bronze(list(rules))
        .groupBy("resource_type", "resource_family", system.alias("source_system"))
        .agg(F.count("*").alias("row_count"))
    )


@on_lake("num_1_number_text")
def _(k: Lake) -> DataFrame:
    rows = silver.parsed(k.bronze(["Observation"]), "Observation")
    printed = R["valueQuantity"]["value"]
    return rows.filter(printed.isNotNull()).select(
        R["id"].alias("observation_id"), number_text(printed).alias("value")
    )


# --- Silver ---------------------------------------------------------------


def silver_query(number: int, name: str) -> None:
    def build(k: Lake) -> DataFrame:
        kind = next(t.resource_type for t in SILVER_TABLES if t.name == name)
        medications = None
        if name == "medication_request":
            medications = k.silver("medication")
        return silver.build_silver(name, k.bronze([kind]), medications)

    on_lake(f"slv_{number}_{name}")(build)


for _number, _table in enumerate(SILVER_TABLES, start=1):
    silver_query(_number, _table.name)


@on_lake("slv_12_lineage")
def _(k: Lake) -> DataFrame:
    rows = k.bronze().select(*silver.lineage())
    keys = [c for c in rows.columns if c != "bronze_resource_id"]
    return rows.groupBy(*keys).agg(F.count("bronze_resource_id").alias("row_count"))


@on_lake("slv_13_build_all")
def _(k: Lake) -> DataFrame:
    built = silver.build_all_silver(k.bronze())
    return tables.union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in built.items()
        ]
    )


@on_lake("slc_1_row_parity")
def _(k: Lake) -> DataFrame:
    return silver_checks.silver_parity(k.spark, k.bronze(), k.silver_tables())


@on_lake("slc_2_ingredient_parents")
def _(k: Lake) -> DataFrame:
    needed = ["medication_ingredient", "medication"]
    return silver_checks.ingredient_parents(k.silver_tables(needed))


@on_lake("slc_3_request_medications")
def _(k: Lake) -> DataFrame:
    needed = ["medication_request", "medication"]
    return silver_checks.request_medications(k.silver_tables(needed))


@on_lake("slc_4_administration_requests")
def _(k: Lake) -> DataFrame:
    needed = ["medication_administration", "medication_request"]
    return silver_checks.administration_requests(k.silver_tables(needed))


@on_lake("slc_5_dispense_requests")
def _(k: Lake) -> DataFrame:
    needed = ["medication_dispense", "medication_request"]
    return silver_checks.dispense_requests(k.silver_tables(needed))


# --- relationships --------------------------------------------------------


def metrics(k: Lake) -> DataFrame:
    """The stored audit, as reports and checks read it."""
    return k.stored(
        "relationship_metrics",
        lambda: relationships.relationship_metrics(k.spark, k.silver_tables()),
    )


@on_lake("rel_1_row_counts")
def _(k: Lake) -> DataFrame:
    counted = relationships.completeness_metrics(k.silver_tables())
    return counted.filter("kind = 'rows'").select("metric", "table_name", "value")


@on_lake("rel_2_missing_references")
def _(k: Lake) -> DataFrame:
    counted = relationships.completeness_metrics(k.silver_tables())
    return counted.filter("kind = 'missing'").select("metric", "table_name", "value")


@on_lake("rel_3_orphans")
def _(k: Lake) -> DataFrame:
    counted = relationships.orphan_metrics(k.spark, k.silver_tables())
    return counted.select("metric", "table_name", "value")


@on_lake("rel_4_table_presence")
def _(k: Lake) -> DataFrame:
    present = k.silver_tables()
    relationships.require_tables(present)
    counted = relationships.completeness_metrics(present).filter("kind = 'rows'")
    return counted.select("table_name", (F.col("value") > 0).alias("has_rows"))


@on_lake("rel_5_verdict")
def _(k: Lake) -> DataFrame:
    return relationships.relationship_verdict(metrics(k))


@on_lake("rel_5_wide_metrics")
def _(k: Lake) -> DataFrame:
    return relationships.relationship_wide(metrics(k))


@on_lake("rel_6_warnings")
def _(k: Lake) -> DataFrame:
    return relationships.relationship_warnings(
        relationships.completeness_metrics(k.silver_tables())
    )


# --- privacy --------------------------------------------------------------


@on_lake("prv_1_rules")
def _(k: Lake) -> DataFrame:
    return privacy.table_rules(k.spark, k.silver_tables())


@on_lake("prv_2_rule_lookup")
def _(k: Lake) -> DataFrame:
    return privacy.rule_lookup(k.spark, k.silver_tables())


@on_lake("prv_3_column_findings")
def _(k: Lake) -> DataFrame:
    return privacy.column_findings(k.spark, k.silver_tables(), with_population=True)


@on_lake("prv_3_findings_of_the_job")
def _(k: Lake) -> DataFrame:
    findings = privacy.column_findings(k.spark, k.silver_tables())
    return findings.drop("populated_rows")


@on_lake("prv_4_pattern_matches")
def _(k: Lake) -> DataFrame:
    """Distinct texts of all scanned columns that hold a match."""
    found = {
        name: F.array_join(privacy.pattern_matches(F.col("text"), name), " | ")
        for name in privacy.PATTERNS
    }
    texts = [
        k.silver(table)
        .filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("text"))
        .agg(F.count("*").alias("row_count"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            "text",
            "row_count",
        )
        for table, columns in privacy.SCAN_COLUMNS.items()
        for column in columns
    ]
    rows = tables.union_all(texts).withColumns(found)
    return rows.filter(F.concat(*[F.col(name) for name in found]) != "")


@on_lake("prv_5_column_scan")
def _(k: Lake) -> DataFrame:
    found = privacy.pattern_findings(k.silver_tables())
    return found.withColumn("sample_matches", F.array_join("sample_matches", " | "))


@on_lake("prv_5_encounter_order")
def _(k: Lake) -> DataFrame:
    """Samples in order of the resources they stand in."""
    by = ["source_file", "bronze_resource_id"]
    found = privacy.pattern_findings(k.silver_tables(), order=by)
    return found.withColumn("sample_matches", F.array_join("sample_matches", " | "))


@on_lake("prv_6_scan_scope")
def _(k: Lake) -> DataFrame:
    return privacy.pattern_counts(k.silver_tables())


@on_lake("prv_7_verdict")
def _(k: Lake) -> DataFrame:
    return privacy.privacy_verdict(privacy.pattern_counts(k.silver_tables()))


@on_lake("prv_8_classification_counts")
def _(k: Lake) -> DataFrame:
    findings = privacy.column_findings(k.spark, k.silver_tables(), with_population=True)
    return privacy.classification_counts(findings)


# --- Gold -----------------------------------------------------------------

_GOLD_NUMBERS = {
    "encounter_summary": 1,
    "condition_summary": 2,
    "vitals_daily": 3,
    "labs_daily": 4,
    "medication_activity": 6,
    "medication_order_fulfillment": 7,
    "procedure_summary": 8,
}


def gold_query(number: int, name: str) -> None:
    from wardlake.harness.stage import GOLD_INPUTS

    on_lake(f"gld_{number}_{name}")(
        lambda k: gold.build_gold(name, k.silver_tables(GOLD_INPUTS[name]))
    )


for _name, _number in _GOLD_NUMBERS.items():
    gold_query(_number, _name)


@on_lake("gld_5_observation_daily")
def _(k: Lake) -> DataFrame:
    inputs = k.silver_tables(["observation", "encounter"])
    return gold.observation_daily(inputs, F.col("code_system") == "obs-sys")


@on_lake("gld_9_stable_keys")
def _(k: Lake) -> DataFrame:
    return k.silver("medication_request").select(
        "medication_request_id",
        stable_key("medication_request", F.col("medication_request_id")).alias(
            "medication_request_key"
        ),
        stable_key("patient", F.col("patient_id")).alias("patient_key"),
        stable_key("encounter", F.col("encounter_id")).alias("encounter_key"),
    )


@on_lake("gld_10_wall_clock")
def _(k: Lake) -> DataFrame:
    return k.silver("encounter").select(
        "encounter_id",
        wall_clock(F.col("start_datetime")).cast("string").alias("start_time"),
        wall_clock(F.col("end_datetime")).cast("string").alias("end_time"),
    )


@on_lake("gld_11_surface")
def _(k: Lake) -> DataFrame:
    return gold.gold_surface(k.gold_tables())


@on_lake("gld_12_build_all")
def _(k: Lake) -> DataFrame:
    built = gold.build_all_gold(k.silver_tables())
    return tables.union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in built.items()
        ]
    )


# --- quality --------------------------------------------------------------


def parity(k: Lake) -> DataFrame:
    return silver_checks.silver_parity(k.spark, k.bronze(), k.silver_tables())


def staged_manifest(k: Lake) -> DataFrame:
    """Manifest of the staged Bronze: rows per file counted in the source text."""

    def count() -> DataFrame:
        lines = [
            testbed.source_lines(k.spark, k.sf_dir, kind) for kind in RESOURCE_TYPES
        ]
        counted = tables.union_all([df.select("source_file") for df in lines])
        return counted.groupBy("source_file").agg(F.count("*").alias("expected_rows"))

    counted = k.stored("manifest", count)
    total = counted.agg(F.sum("expected_rows").alias("n")).first()["n"]
    return counted.withColumn("total_rows", F.lit(total).cast("bigint"))


def bronze_check(k: Lake) -> DataFrame:
    return quality.bronze_manifest_check(staged_manifest(k), k.bronze())


def privacy_checks(k: Lake) -> DataFrame:
    counts = privacy.pattern_counts(k.silver_tables())
    return quality.privacy_check(privacy.privacy_verdict(counts))


def all_checks(k: Lake) -> DataFrame:
    return tables.union_all(
        [
            bronze_check(k),
            quality.parity_checks(parity(k)),
            quality.required_id_checks(k.silver_tables()),
            quality.relationship_checks(metrics(k)),
            privacy_checks(k),
            quality.gold_surface_checks(gold.gold_surface(k.gold_tables())),
            quality.gold_metric_checks(k.gold_tables()),
        ]
    )


def stored_checks(k: Lake) -> DataFrame:
    """The stored check rows, as the report and the marts read them."""
    return k.stored("checks", lambda: all_checks(k))


@on_lake("qlt_1_check_rows")
def _(k: Lake) -> DataFrame:
    return stored_checks(k)


@on_lake("qlt_2_guarded_checks")
def _(k: Lake) -> DataFrame:
    """A group that succeeds and one that lacks a table."""
    some = k.silver_tables(["patient", "encounter"])
    fine = quality.guarded(
        k.spark, "silver_row_counts", "silver", lambda: quality.parity_checks(parity(k))
    )
    broken = quality.guarded(
        k.spark,
        "silver_required_ids",
        "silver",
        lambda: quality.required_id_checks(some),
    )
    return fine.unionByName(broken).drop("details")


@on_lake("qlt_3_bronze_manifest")
def _(k: Lake) -> DataFrame:
    return bronze_check(k)


@on_lake("qlt_4_row_parity")
def _(k: Lake) -> DataFrame:
    return quality.parity_checks(parity(k))


@on_lake("qlt_5_required_ids")
def _(k: Lake) -> DataFrame:
    return quality.required_id_checks(k.silver_tables())


@on_lake("qlt_6_relationships")
def _(k: Lake) -> DataFrame:
    return quality.relationship_checks(metrics(k))


@on_lake("qlt_7_privacy")
def _(k: Lake) -> DataFrame:
    return privacy_checks(k)


@on_lake("qlt_8_gold_surface")
def _(k: Lake) -> DataFrame:
    return quality.gold_surface_checks(gold.gold_surface(k.gold_tables()))


@on_lake("qlt_9_unique_encounters")
def _(k: Lake) -> DataFrame:
    return quality.unique_encounter_check(k.gold("encounter_summary"))


def daily_check(k: Lake, part: str) -> DataFrame:
    return tables.union_all(
        [
            quality.daily_checks(k.gold(f"{label}_daily"), label, part)
            for label in ("vitals", "labs")
        ]
    )


@on_lake("qlt_10_positive_counts")
def _(k: Lake) -> DataFrame:
    return daily_check(k, "positive_counts")


@on_lake("qlt_11_value_ordering")
def _(k: Lake) -> DataFrame:
    return daily_check(k, "value_ordering")


@on_lake("qlt_12_report")
def _(k: Lake) -> DataFrame:
    return quality.quality_report(stored_checks(k))


@on_lake("qlt_13_layer_summary")
def _(k: Lake) -> DataFrame:
    return quality.layer_summary(stored_checks(k))


@on_lake("qlt_14_expected_counts")
def _(k: Lake) -> DataFrame:
    named = {"bronze": ("bronze", k.bronze())}
    named |= {f"silver_{n}": ("silver", df) for n, df in k.silver_tables().items()}
    named |= {f"gold_{n}": ("gold", df) for n, df in k.gold_tables().items()}
    return quality.expected_count_checks(
        k.spark, quality.table_rows(named), known_counts(k)
    )


# --- marts ----------------------------------------------------------------

_GOLD_MARTS = {
    "mrt_1_encounters_by_class": (marts.encounters_by_class, "encounter_summary"),
    "mrt_2_discharge_dispositions": (marts.discharge_dispositions, "encounter_summary"),
    "mrt_3_length_of_stay_bins": (marts.length_of_stay_bins, "encounter_summary"),
    "mrt_4_observation_load_bins": (marts.observation_load_bins, "encounter_summary"),
    "mrt_6_vitals_volume": (marts.vitals_volume, "vitals_daily"),
    "mrt_7_labs_volume": (marts.labs_volume, "labs_daily"),
    "mrt_8_vitals_trend": (marts.vitals_trend, "vitals_daily"),
    "mrt_9_labs_trend": (marts.labs_trend, "labs_daily"),
    "mrt_10_medication_by_activity": (
        marts.medication_by_activity,
        "medication_activity",
    ),
    "mrt_11_top_medications": (marts.top_medications, "medication_activity"),
    "mrt_12_fulfillment_paths": (
        marts.fulfillment_paths,
        "medication_order_fulfillment",
    ),
    "mrt_13_top_procedures": (marts.top_procedures, "procedure_summary"),
}


def mart_query(name: str, build: Callable, table: str) -> None:
    on_lake(name)(lambda k: build(k.gold_tables([table])))


for _name, (_build, _source) in _GOLD_MARTS.items():
    mart_query(_name, _build, _source)


@on_lake("mrt_5_top_conditions")
def _(k: Lake) -> DataFrame:
    return marts.top_conditions(k.silver_tables(["condition"]))


@on_lake("mrt_14_table_counts")
def _(k: Lake) -> DataFrame:
    return marts.table_counts(k.bronze(), k.silver_tables(), k.gold_tables())


def headline(k: Lake) -> DataFrame:
    counts = marts.table_counts(k.bronze(), k.silver_tables(), k.gold_tables())
    return marts.headline_metrics(counts, quality.quality_report(stored_checks(k)))


@on_lake("mrt_15_headline_metrics")
def _(k: Lake) -> DataFrame:
    return headline(k)


@on_lake("mrt_16_mart_validation")
def _(k: Lake) -> DataFrame:
    sections = {
        name.split("_", 2)[2]: build(k.gold_tables([table]))
        for name, (build, table) in _GOLD_MARTS.items()
    }
    # The headline is asserted on several times: write it once.
    top = k.stored("headline", lambda: headline(k))
    expected = {
        "patients": known_counts(k)["silver_patient"],
        "procedures": WRONG_COUNTS["silver_procedure"],
    }
    return marts.mart_validation(sections, top, metrics(k), expected)


# --- job ------------------------------------------------------------------


def job(k: Lake) -> DataFrame:
    """Run log of one whole run over the landed files."""
    path = f"{k.root}/run"

    def run() -> None:
        run_pipeline(
            k.spark, k.landing(), path, testbed.DATASET_NAME, testbed.DATASET_VERSION
        )

    k._once("job", run)
    return k.spark.read.parquet(f"{path}/run_log")


@on_lake("job_1_pipeline")
def _(k: Lake) -> DataFrame:
    return job(k).select("step", "name", "status", "rows")


@on_lake("job_2_run_log")
def _(k: Lake) -> DataFrame:
    return job(k).agg(
        F.count("*").alias("steps"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.max_by("name", "step").alias("last_step"),
        F.when(F.bool_and(F.col("status") == "success"), "success")
        .otherwise("failed")
        .alias("status"),
        F.max(F.substring_index("error", ":", 1)).alias("error_type"),
    )


@on_lake("job_1_clean_pipeline")
def _(k: Lake) -> DataFrame:
    """The run over the landing that holds nothing to object to."""
    path = f"{k.root}/clean-run"

    def run() -> None:
        folder = k.clean_landing()
        run_pipeline(
            k.spark, folder, path, testbed.DATASET_NAME, testbed.DATASET_VERSION
        )

    k._once("clean-job", run)
    log = k.spark.read.parquet(f"{path}/run_log")
    return log.select("step", "name", "status", (F.col("rows") > 0).alias("has_rows"))


__all__ = ["COUNTED_AS", "QUERIES", "WRONG_COUNTS"]
