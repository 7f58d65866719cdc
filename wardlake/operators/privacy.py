"""Privacy audit: governed columns and identifier-like values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.plans.registry import LINEAGE_COLUMNS, SILVER_TABLES
from wardlake.sources.tables import static_table, union_all

Tables = Mapping[str, DataFrame]

SAMPLE_SIZE = 5
# Matches of a cell are folded into so many slots to find how far to look for samples.
SAMPLE_SLOTS = 256
CELL = ["table_name", "column_name", "pattern_name"]

# The governed Silver columns in audit order, each as table, column,
# classification, publishable by default, and rationale.
COLUMN_RULES = (
    (
        "patient",
        "source_patient_identifier",
        "direct_identifier",
        False,
        "Raw source subject identifier carried from the FHIR Patient identifier.",
    ),
    (
        "patient",
        "synthetic_patient_name",
        "direct_identifier",
        False,
        "Synthetic patient label derived from the source subject identifier.",
    ),
    (
        "patient",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable row-level Patient resource id that links clinical events.",
    ),
    (
        "patient",
        "birth_date",
        "date_precision",
        False,
        "Fine-grained patient birth date should not be exposed in publishable outputs.",
    ),
    (
        "patient",
        "deceased_datetime",
        "date_precision",
        False,
        "Fine-grained death timestamp should be generalized before publication.",
    ),
    (
        "patient",
        "gender",
        "demographic_attribute",
        False,
        "Patient demographic attribute that may contribute to re-identification risk.",
    ),
    (
        "patient",
        "race",
        "demographic_attribute",
        False,
        "Patient demographic attribute that may contribute to re-identification risk.",
    ),
    (
        "patient",
        "ethnicity",
        "demographic_attribute",
        False,
        "Patient demographic attribute that may contribute to re-identification risk.",
    ),
    (
        "patient",
        "birth_sex",
        "demographic_attribute",
        False,
        "Patient demographic attribute that may contribute to re-identification risk.",
    ),
    (
        "patient",
        "marital_status_code",
        "demographic_attribute",
        False,
        "Patient demographic attribute that may contribute to re-identification risk.",
    ),
    (
        "encounter",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable row-level Encounter resource id that links clinical events.",
    ),
    (
        "encounter",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on Encounter rows for joins.",
    ),
    (
        "encounter",
        "start_datetime",
        "date_precision",
        False,
        "Fine-grained encounter start timestamp should be generalized before publication.",
    ),
    (
        "encounter",
        "end_datetime",
        "date_precision",
        False,
        "Fine-grained encounter end timestamp should be generalized before publication.",
    ),
    (
        "encounter",
        "admit_source",
        "clinical_attribute",
        True,
        "Encounter attribute that describes care context.",
    ),
    (
        "encounter",
        "discharge_disposition",
        "clinical_attribute",
        True,
        "Encounter attribute that describes care outcome context.",
    ),
    (
        "observation",
        "observation_id",
        "linkage_identifier",
        False,
        "Stable row-level Observation resource id.",
    ),
    (
        "observation",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on Observation rows for joins.",
    ),
    (
        "observation",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on Observation rows for joins.",
    ),
    (
        "observation",
        "effective_datetime",
        "date_precision",
        False,
        "Fine-grained observation timestamp should be generalized before publication.",
    ),
    (
        "observation",
        "issued_datetime",
        "date_precision",
        False,
        "Fine-grained issued timestamp should be generalized before publication.",
    ),
    (
        "observation",
        "display",
        "clinical_attribute",
        True,
        "Clinical display text should be reviewed before broad publication.",
    ),
    (
        "observation",
        "value",
        "clinical_free_text",
        True,
        "String observation values may contain unexpected free-text content.",
    ),
    (
        "condition",
        "condition_id",
        "linkage_identifier",
        False,
        "Stable row-level Condition resource id.",
    ),
    (
        "condition",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on Condition rows for joins.",
    ),
    (
        "condition",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on Condition rows for joins.",
    ),
    (
        "condition",
        "display",
        "clinical_attribute",
        True,
        "Clinical diagnosis display text should be reviewed before broad publication.",
    ),
    (
        "medication",
        "medication_id",
        "linkage_identifier",
        False,
        "Stable row-level Medication resource id.",
    ),
    (
        "medication",
        "medication_display",
        "clinical_attribute",
        True,
        "Medication display text should be reviewed before broad publication.",
    ),
    (
        "medication",
        "medication_text",
        "clinical_attribute",
        True,
        "Medication concept text should be reviewed before broad publication.",
    ),
    (
        "medication_ingredient",
        "medication_id",
        "linkage_identifier",
        False,
        "Parent Medication resource id for mixture ingredients.",
    ),
    (
        "medication_ingredient",
        "ingredient_medication_id",
        "linkage_identifier",
        False,
        "Referenced ingredient Medication resource id.",
    ),
    (
        "medication_request",
        "medication_request_id",
        "linkage_identifier",
        False,
        "Stable row-level MedicationRequest resource id.",
    ),
    (
        "medication_request",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on MedicationRequest rows for joins.",
    ),
    (
        "medication_request",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on MedicationRequest rows for joins.",
    ),
    (
        "medication_request",
        "authored_datetime",
        "date_precision",
        False,
        "Fine-grained medication order timestamp should be generalized in Gold.",
    ),
    (
        "medication_request",
        "medication_display",
        "clinical_attribute",
        True,
        "Medication order display text should be reviewed before publication.",
    ),
    (
        "medication_administration",
        "medication_administration_id",
        "linkage_identifier",
        False,
        "Stable row-level MedicationAdministration resource id.",
    ),
    (
        "medication_administration",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on administration rows for joins.",
    ),
    (
        "medication_administration",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on administration rows for joins.",
    ),
    (
        "medication_administration",
        "effective_start_datetime",
        "date_precision",
        False,
        "Fine-grained administration timestamp should be generalized in Gold.",
    ),
    (
        "medication_administration",
        "effective_end_datetime",
        "date_precision",
        False,
        "Fine-grained administration end timestamp should be generalized in Gold.",
    ),
    (
        "medication_administration",
        "medication_display",
        "clinical_attribute",
        True,
        "Medication administration display text should be reviewed.",
    ),
    (
        "medication_dispense",
        "medication_dispense_id",
        "linkage_identifier",
        False,
        "Stable row-level MedicationDispense resource id.",
    ),
    (
        "medication_dispense",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on dispense rows for joins.",
    ),
    (
        "medication_dispense",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on dispense rows for joins.",
    ),
    (
        "medication_dispense",
        "when_handed_over_datetime",
        "date_precision",
        False,
        "Fine-grained dispense timestamp should be generalized in Gold.",
    ),
    (
        "medication_dispense",
        "medication_display",
        "clinical_attribute",
        True,
        "Medication dispense display text should be reviewed.",
    ),
    (
        "medication_dispense",
        "medication_text",
        "clinical_attribute",
        True,
        "Medication dispense text should be reviewed.",
    ),
    (
        "medication_statement",
        "medication_statement_id",
        "linkage_identifier",
        False,
        "Stable row-level MedicationStatement resource id.",
    ),
    (
        "medication_statement",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on medication statement rows for joins.",
    ),
    (
        "medication_statement",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on medication statement rows for joins.",
    ),
    (
        "medication_statement",
        "date_asserted_datetime",
        "date_precision",
        False,
        "Fine-grained asserted medication timestamp should be generalized in Gold.",
    ),
    (
        "medication_statement",
        "medication_display",
        "clinical_attribute",
        True,
        "Medication statement display text should be reviewed.",
    ),
    (
        "medication_statement",
        "medication_text",
        "clinical_attribute",
        True,
        "Medication statement text should be reviewed.",
    ),
    (
        "procedure",
        "procedure_id",
        "linkage_identifier",
        False,
        "Stable row-level Procedure resource id.",
    ),
    (
        "procedure",
        "patient_id",
        "linkage_identifier",
        False,
        "Stable Patient id repeated on Procedure rows for joins.",
    ),
    (
        "procedure",
        "encounter_id",
        "linkage_identifier",
        False,
        "Stable Encounter id repeated on Procedure rows for joins.",
    ),
    (
        "procedure",
        "performed_start_datetime",
        "date_precision",
        False,
        "Fine-grained procedure timestamp should be generalized in Gold.",
    ),
    (
        "procedure",
        "performed_end_datetime",
        "date_precision",
        False,
        "Fine-grained procedure end timestamp should be generalized in Gold.",
    ),
    (
        "procedure",
        "procedure_display",
        "clinical_attribute",
        True,
        "Procedure display text should be reviewed before broad publication.",
    ),
)
LINEAGE_CLASSIFICATION = "lineage_metadata"
LINEAGE_RATIONALE = (
    "Operational lineage column for traceability, not a Gold presentation field."
)

# Identifier-like patterns and the text columns they are run on.
PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "phone": r"\b(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s])\d{3}[-.\s]\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "ipv4": (
        r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}"
        r"(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"
    ),
    "url": r"\bhttps?://[^\s]+",
}
SCAN_COLUMNS = {
    "patient": ("source_patient_identifier", "synthetic_patient_name"),
    "encounter": ("admit_source", "discharge_disposition"),
    "observation": ("display", "value"),
    "condition": ("display",),
    "medication": ("medication_display", "medication_text"),
    "medication_request": ("medication_display",),
    "medication_administration": ("medication_display",),
    "medication_dispense": ("medication_display", "medication_text"),
    "medication_statement": ("medication_display", "medication_text"),
    "procedure": ("procedure_display", "body_site_display"),
}


def column_rules() -> list[tuple[str, str, str, str, bool]]:
    """(table, column, classification, rationale, publishable) of all 138 rules."""
    explicit = [
        (table, column, kind, rationale, publishable)
        for table, column, kind, publishable, rationale in COLUMN_RULES
    ]
    lineage = [
        (table.name, column, LINEAGE_CLASSIFICATION, LINEAGE_RATIONALE, False)
        for table in SILVER_TABLES
        for column in LINEAGE_COLUMNS
    ]
    return explicit + lineage


def privacy_rules(spark: SparkSession) -> DataFrame:
    """The rule table: fixed metadata, the only side ever worth broadcasting."""
    table, column, kind, rationale, publishable = zip(*column_rules(), strict=True)
    return static_table(
        spark,
        table_name=list(table),
        column_name=list(column),
        classification=list(kind),
        rationale=list(rationale),
        publishable_default=list(publishable),
    )


def column_population(silver: Tables) -> DataFrame:
    """Populated rows of every column of every table, one fold per table."""
    if not silver:
        raise ValueError("No Silver tables found for privacy audit.")
    parts = []
    for name, df in silver.items():
        folded = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"), F.col(c).alias("populated_rows")
                )
                for c in df.columns
            ]
        )
        parts.append(
            folded.select(
                F.lit(name).alias("table_name"),
                F.col("_rows").alias("table_rows"),
                F.inline(entries),
            )
        )
    return union_all(parts)


def table_rules(spark: SparkSession, silver: Tables) -> DataFrame:
    """Rules per governed table and classification, with the rows they govern."""
    rows = column_population(silver).groupBy("table_name").agg(
        F.max("table_rows").alias("table_rows")
    )
    return (
        privacy_rules(spark)
        .join(rows, "table_name", "left")
        .groupBy("table_name", "classification", "publishable_default")
        .agg(
            F.count("*").alias("rule_count"),
            F.max(F.coalesce("table_rows", F.lit(0))).alias("governed_rows"),
        )
    )


def rule_lookup(spark: SparkSession, silver: Tables) -> DataFrame:
    """The rule of every existing column; columns without a rule show none."""
    return (
        column_population(silver)
        .join(privacy_rules(spark), ["table_name", "column_name"], "left")
        .select(
            "table_name",
            "column_name",
            "classification",
            "publishable_default",
            "populated_rows",
        )
    )


def existing_columns(spark: SparkSession, silver: Tables) -> DataFrame:
    """All columns of all tables, from their schemas: nothing is read."""
    if not silver:
        raise ValueError("No Silver tables found for privacy audit.")
    pairs = [(name, column) for name, df in silver.items() for column in df.columns]
    return static_table(
        spark,
        table_name=[table for table, _ in pairs],
        column_name=[column for _, column in pairs],
    )


def column_findings(
    spark: SparkSession, silver: Tables, with_population: bool = False
) -> DataFrame:
    """Every rule and whether its column exists.

    ``with_population`` adds how many rows populate the column, which reads all
    governed tables once.
    """
    cell = ["table_name", "column_name"]
    found = (
        column_population(silver)
        if with_population
        else existing_columns(spark, silver)
    ).withColumn("found", F.lit(True))
    rows = [F.coalesce("populated_rows", F.lit(0)).alias("populated_rows")]
    return (
        privacy_rules(spark)
        .join(found, cell, "left")
        .select(
            *cell,
            "classification",
            "rationale",
            F.col("found").isNotNull().alias("present"),
            "publishable_default",
            *(rows if with_population else []),
        )
    )


def classification_counts(findings: DataFrame) -> DataFrame:
    """Present columns per classification, with their populated values if known."""
    measures = [F.count("*").alias("column_count")]
    if "populated_rows" in findings.columns:
        measures.append(F.sum("populated_rows").alias("populated_values"))
    return findings.filter("present").groupBy("classification").agg(*measures)


def unicode_pattern(pattern: str) -> str:
    """Letters, digits, spaces and word limits in their Unicode sense."""
    return "(?U)" + pattern


def pattern_matches(text: Column, pattern_name: str) -> Column:
    """Sorted distinct matches of one pattern in a text."""
    pattern = F.lit(unicode_pattern(PATTERNS[pattern_name]))
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, pattern, 0)))
    return F.when(_may_match(text, pattern_name), found).when(
        text.isNotNull(), F.array().cast("array<string>")
    )


def _may_match(text: Column, pattern_name: str) -> Column:
    """A cheap test every match of the pattern passes: a needed sign, a length."""
    sign, shortest = {
        "email": ("@", 6),
        "phone": (None, 12),
        "ssn": ("-", 11),
        "ipv4": (".", 7),
        "url": ("://", 8),
    }[pattern_name]
    long_enough = F.length(text) >= shortest
    return long_enough & F.contains(text, F.lit(sign)) if sign else long_enough


def has_pattern(text: Column, pattern_name: str) -> Column:
    pattern = unicode_pattern(PATTERNS[pattern_name])
    return _may_match(text, pattern_name) & text.rlike(pattern)


def scan_scope(silver: Tables) -> dict[str, list[str]]:
    """Text columns to scan, limited to tables and columns that exist."""
    return {
        table: [c for c in columns if c in silver[table].columns]
        for table, columns in SCAN_COLUMNS.items()
        if table in silver
    }


def pattern_counts(
    silver: Tables, scope: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """Rows with at least one match, per table, column and pattern.

    One fold per table covers all its columns and patterns.
    """
    parts = []
    for table, columns in (scope or scan_scope(silver)).items():
        cells = [(column, name) for column in columns for name in PATTERNS]
        if not cells:
            continue
        folded = silver[table].agg(
            *[
                F.count_if(has_pattern(F.col(column), name)).alias(f"{column}~{name}")
                for column, name in cells
            ]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(column).alias("column_name"),
                    F.lit(name).alias("pattern_name"),
                    F.col(f"`{column}~{name}`").alias("match_count"),
                )
                for column, name in cells
            ]
        )
        parts.append(
            folded.select(F.lit(table).alias("table_name"), F.inline(entries))
        )
    return union_all(parts)


def matches_by_cell(table: str, rows: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """(cell, more, match): every match of every pattern in the columns of a table."""
    hits = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(name).alias("pattern_name"),
                pattern_matches(F.col(column), name).alias("matches"),
            )
            for column in columns
            for name in PATTERNS
        ]
    )
    return (
        rows.select(*more, F.inline(hits))
        .filter(F.size("matches") > 0)
        .select(F.lit(table).alias("table_name"), *CELL[1:], *more, F.explode("matches").alias("match"))
    )


def pattern_samples(
    silver: Tables,
    sample_size: int = SAMPLE_SIZE,
    scope: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """The first distinct matches, in text order, per table, column and pattern.

    Matches are made distinct before they are ranked, and the rank limit is
    applied inside every task before the exchange.
    """
    parts = [
        matches_by_cell(table, silver[table], columns)
        for table, columns in (scope or scan_scope(silver)).items()
        if columns
    ]
    ranked = (
        union_all(parts)
        .distinct()
        .withColumn("rank", F.row_number().over(Window.partitionBy(*CELL).orderBy("match")))
        .filter(F.col("rank") <= sample_size)
    )
    return ranked.groupBy(*CELL).agg(
        F.array_sort(F.collect_list("match")).alias("sample_matches")
    )


def with_row_place(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``row_place``: the columns ``by`` or, without any, the file a row is
    stored in, by path, and its number there. Rows that are not read from files are
    numbered as they come."""
    if by:
        return rows.select("*", F.struct(*by).alias("row_place"))
    try:
        stored = F.struct("_metadata.file_path", "_metadata.row_index")
        return rows.select("*", stored.alias("row_place"))
    except AnalysisException:
        coming = F.struct(
            F.lit("").alias("file_path"), F.monotonically_increasing_id().alias("row_index")
        )
        return rows.select("*", coming.alias("row_place"))


def encountered_samples(
    silver: Tables,
    sample_size: int = SAMPLE_SIZE,
    scope: Mapping[str, list[str]] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The first distinct matches in the order of the columns ``by``, or without any in
    which the tables store their rows, and in text order inside a row, per table, column
    and pattern.

    Matches are dealt to ``SAMPLE_SLOTS`` slots by a hash, and only the first place
    of each slot is folded. Up to the place where ``sample_size`` slots have begun
    there are as many distinct matches, so none behind it is a sample; what lies
    before it is few, and is told apart exactly. Where fewer slots begin, a cell has as
    good as surely fewer distinct matches than samples, and all are looked at. A task
    sends one row for each slot or remaining match of a cell.
    """
    parts = [
        matches_by_cell(table, with_row_place(silver[table], by), columns, "row_place")
        for table, columns in (scope or scan_scope(silver)).items()
        if columns
    ]
    seen = union_all(parts).select(*CELL, "match", F.struct("row_place", "match").alias("place"))
    by_place = Window.partitionBy(*CELL).orderBy("place")
    slot = F.pmod(F.xxhash64("match"), F.lit(SAMPLE_SLOTS)).alias("slot")
    # One row per scanned cell, so this may be broadcast.
    limits = (
        seen.groupBy(*CELL, slot)
        .agg(F.min("place").alias("place"))
        .withColumn("begun", F.row_number().over(by_place))
        .filter(F.col("begun") == sample_size)
        .select(*CELL, F.col("place").alias("limit"))
    )
    near = seen.join(F.broadcast(limits), CELL, "left").filter(
        F.col("limit").isNull() | (F.col("place") <= F.col("limit"))
    )
    ranked = (
        near.groupBy(*CELL, "match")
        .agg(F.min("place").alias("place"))
        .withColumn("rank", F.row_number().over(by_place))
        .filter(F.col("rank") <= sample_size)
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", "match")))
    return ranked.groupBy(*CELL).agg(listed["match"].alias("sample_matches"))


def samples_in(
    order: str | Sequence[str],
    silver: Tables,
    sample_size: int,
    scope: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Samples by ``"text"``, as rows are ``"stored"``, or by columns of the tables."""
    if order == "text":
        return pattern_samples(silver, sample_size, scope)
    return encountered_samples(silver, sample_size, scope, () if order == "stored" else order)


def pattern_findings(
    silver: Tables, sample_size: int = SAMPLE_SIZE, order: str | Sequence[str] = "text"
) -> DataFrame:
    """Cells with matches: row count and a few sample matches.

    The samples are the first matches in text order, which is the same in every run,
    with ``order="stored"`` the first that a reader of the tables encounters, or the
    first in order of columns that are named.
    """
    counts = pattern_counts(silver).filter(F.col("match_count") > 0)
    samples = samples_in(order, silver, sample_size)
    return counts.join(samples, CELL, "left")


def findings_where_counted(
    silver: Tables,
    counts: DataFrame,
    sample_size: int = SAMPLE_SIZE,
    order: str | Sequence[str] = "text",
) -> DataFrame | None:
    """Findings from stored counts: only text columns with a hit are re-read.

    The counts table has one row per scanned cell, so listing its hits on the
    driver is bounded by the scope. Without a hit there is nothing to build.
    """
    hits = counts.filter(F.col("match_count") > 0)
    scope: dict[str, list[str]] = {}
    for row in hits.select("table_name", "column_name").distinct().collect():
        scope.setdefault(row["table_name"], []).append(row["column_name"])
    if not scope:
        return None
    samples = samples_in(order, silver, sample_size, scope)
    return hits.join(samples, CELL, "left")


def privacy_verdict(counts: DataFrame) -> DataFrame:
    """One row: passed without findings, else needs_review."""
    return counts.agg(
        F.count_if(F.col("match_count") > 0).alias("finding_count")
    ).withColumn(
        "status",
        F.when(F.col("finding_count") == 0, "passed").otherwise("needs_review"),
    )
