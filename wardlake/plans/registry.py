"""Table registry: names, column layouts, required ids and references.

This is driver-side metadata only. Builds, checks, audits and reports all take
their scope from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _layout(text: str) -> tuple[tuple[str, str], ...]:
    """Parse ``"name name:type ..."``; columns without a type are strings."""
    pairs = []
    for item in text.split():
        name, _, kind = item.partition(":")
        pairs.append((name, kind or "string"))
    return tuple(pairs)


def _struct(layout: tuple[tuple[str, str], ...]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[k], True) for n, k in layout])


BRONZE_TABLE = "fhir_resources"
BRONZE_LAYOUT = _layout(
    "resource_type resource_id source_file resource_family profile_url "
    "source_dataset_name source_dataset_version ingested_at raw_json"
)
BRONZE_COLUMNS = tuple(name for name, _ in BRONZE_LAYOUT)
BRONZE_SCHEMA = _struct(BRONZE_LAYOUT)

LINEAGE_COLUMNS = (
    "source_file",
    "resource_family",
    "profile_url",
    "source_dataset_name",
    "source_dataset_version",
    "bronze_ingested_at",
    "bronze_resource_id",
)


@dataclass(frozen=True)
class Reference:
    """A key column, the table it points to, and what a gap in it means."""

    column: str
    target: str | None
    short: str = ""
    count_missing: bool = True
    warning: str | None = None

    @property
    def label(self) -> str:
        return self.short or self.column


@dataclass(frozen=True)
class SilverTable:
    name: str
    resource_type: str
    layout: tuple[tuple[str, str], ...]
    required: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    medication_event: bool = False
    derived: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.layout) + LINEAGE_COLUMNS

    @property
    def schema(self) -> T.StructType:
        lineage = tuple((name, "string") for name in LINEAGE_COLUMNS)
        return _struct(self.layout + lineage)

    @property
    def required_text(self) -> str:
        names = self.required
        if len(names) > 2:
            listed = ", ".join(names[:-1]) + f", and {names[-1]}"
        else:
            listed = " and ".join(names)
        return f"{listed} present"


def _patient(**options) -> Reference:
    return Reference("patient_id", "patient", **options)


def _encounter(**options) -> Reference:
    return Reference("encounter_id", "encounter", **options)


SILVER_TABLES = (
    SilverTable(
        "patient",
        "Patient",
        _layout(
            "patient_id source_patient_identifier synthetic_patient_name gender "
            "birth_date deceased_datetime race ethnicity birth_sex "
            "marital_status_code"
        ),
        ("patient_id",),
    ),
    SilverTable(
        "encounter",
        "Encounter",
        _layout(
            "encounter_id patient_id status class_code class_display "
            "start_datetime end_datetime service_type_code admit_source "
            "discharge_disposition discharge_disposition_display"
        ),
        ("encounter_id", "patient_id"),
    ),
    SilverTable(
        "observation",
        "Observation",
        _layout(
            "observation_id patient_id encounter_id status effective_datetime "
            "issued_datetime category_code category_system category_display code "
            "code_system display value_type value unit specimen_id"
        ),
        ("observation_id", "patient_id"),
        (
            _patient(),
            _encounter(
                warning="An observation may stand outside any encounter."
            ),
        ),
    ),
    SilverTable(
        "condition",
        "Condition",
        _layout(
            "condition_id patient_id encounter_id category_code category_system "
            "category_display code code_system display"
        ),
        ("condition_id", "patient_id"),
        (_patient(), _encounter()),
    ),
    SilverTable(
        "medication",
        "Medication",
        _layout(
            "medication_id medication_code medication_code_system "
            "medication_display medication_text form_code form_display "
            "is_mix:boolean identifier_count:bigint ingredient_count:bigint"
        ),
        ("medication_id",),
    ),
    SilverTable(
        "medication_ingredient",
        "Medication",
        _layout(
            "medication_id ingredient_index:bigint ingredient_medication_id "
            "ingredient_code ingredient_code_system ingredient_display "
            "strength_numerator_value strength_numerator_unit "
            "strength_denominator_value strength_denominator_unit"
        ),
        ("medication_id",),
        (
            Reference("medication_id", "medication", count_missing=False),
            Reference("ingredient_medication_id", "medication", count_missing=False),
        ),
        derived=True,
    ),
    SilverTable(
        "medication_request",
        "MedicationRequest",
        _layout(
            "medication_request_id patient_id encounter_id status intent "
            "authored_datetime medication_id medication_code "
            "medication_code_system medication_display medication_source_type "
            "route_code route_display dose_value dose_unit frequency period "
            "period_unit validity_start_datetime validity_end_datetime "
            "dosage_instruction_count:bigint"
        ),
        ("medication_request_id", "patient_id"),
        (
            _patient(),
            _encounter(),
            Reference("medication_id", "medication", count_missing=False),
        ),
        medication_event=True,
    ),
    SilverTable(
        "medication_administration",
        "MedicationAdministration",
        _layout(
            "medication_administration_id patient_id encounter_id status "
            "category_code category_display effective_start_datetime "
            "effective_end_datetime medication_code medication_code_system "
            "medication_display medication_request_id dose_value dose_unit "
            "method_code method_display source_system "
            "has_request_reference:boolean has_encounter_context:boolean"
        ),
        ("medication_administration_id", "patient_id"),
        (
            _patient(),
            _encounter(
                warning="An administration may come without its encounter."
            ),
            Reference(
                "medication_request_id",
                "medication_request",
                short="request_id",
                warning="Administrations, in the ICU above all, may have no order.",
            ),
        ),
        medication_event=True,
    ),
    SilverTable(
        "medication_dispense",
        "MedicationDispense",
        _layout(
            "medication_dispense_id patient_id encounter_id status "
            "when_handed_over_datetime medication_code medication_code_system "
            "medication_display medication_text medication_request_id "
            "authorizing_prescription_count:bigint route_code route_display "
            "frequency period period_unit source_system "
            "has_request_reference:boolean"
        ),
        ("medication_dispense_id", "patient_id"),
        (
            _patient(),
            _encounter(),
            Reference(
                "medication_request_id",
                "medication_request",
                short="request_id",
                warning="Emergency dispenses come without an order.",
            ),
        ),
        medication_event=True,
    ),
    SilverTable(
        "medication_statement",
        "MedicationStatement",
        _layout(
            "medication_statement_id patient_id encounter_id status "
            "date_asserted_datetime medication_code medication_code_system "
            "medication_display medication_text source_system"
        ),
        ("medication_statement_id", "patient_id"),
        (_patient(), _encounter()),
        medication_event=True,
    ),
    SilverTable(
        "procedure",
        "Procedure",
        _layout(
            "procedure_id patient_id encounter_id status "
            "performed_start_datetime performed_end_datetime category_code "
            "category_display procedure_code procedure_code_system "
            "procedure_display body_site_code body_site_display source_system"
        ),
        ("procedure_id", "patient_id", "encounter_id"),
        (_patient(), _encounter()),
    ),
)

SILVER = {table.name: table for table in SILVER_TABLES}
RESOURCE_TABLES = tuple(table for table in SILVER_TABLES if not table.derived)
MEDICATION_EVENTS = tuple(table for table in SILVER_TABLES if table.medication_event)


@dataclass(frozen=True)
class GoldTable:
    name: str
    layout: tuple[tuple[str, str], ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.layout)

    @property
    def schema(self) -> T.StructType:
        return _struct(self.layout)


_DAILY = _layout(
    "patient_key encounter_key event_day_index:bigint measurement_name unit "
    "measurement_count:bigint min_value:double avg_value:double max_value:double"
)

GOLD_TABLES = (
    GoldTable(
        "encounter_summary",
        _layout(
            "encounter_key patient_key encounter_status encounter_class "
            "encounter_class_display encounter_start_year:int "
            "encounter_start_month:int length_of_stay_hours:bigint "
            "observation_count:bigint condition_count:bigint "
            "distinct_condition_count:bigint medication_request_count:bigint "
            "medication_administration_count:bigint "
            "medication_dispense_count:bigint medication_statement_count:bigint "
            "procedure_count:bigint distinct_medication_count:bigint "
            "distinct_procedure_count:bigint discharge_disposition"
        ),
    ),
    GoldTable(
        "condition_summary",
        _layout(
            "condition_code condition_display encounter_class "
            "encounter_class_display patient_count:bigint encounter_count:bigint "
            "condition_row_count:bigint"
        ),
    ),
    GoldTable("vitals_daily", _DAILY),
    GoldTable("labs_daily", _DAILY),
    GoldTable(
        "medication_activity",
        _layout(
            "medication_code medication_display activity_type source_system "
            "encounter_class encounter_class_display patient_count:bigint "
            "encounter_count:bigint event_count:bigint "
            "with_encounter_context_count:bigint "
            "without_encounter_context_count:bigint"
        ),
    ),
    GoldTable(
        "medication_order_fulfillment",
        _layout(
            "medication_request_key patient_key encounter_key medication_code "
            "medication_display request_status request_intent authored_year:int "
            "administration_count:bigint dispense_count:bigint "
            "first_administration_datetime first_dispense_datetime "
            "has_administration:boolean has_dispense:boolean fulfillment_path"
        ),
    ),
    GoldTable(
        "procedure_summary",
        _layout(
            "procedure_code procedure_display source_system encounter_class "
            "encounter_class_display patient_count:bigint encounter_count:bigint "
            "procedure_count:bigint with_body_site_count:bigint"
        ),
    ),
)

GOLD = {table.name: table for table in GOLD_TABLES}

# Columns that must never reach a publishable table.
FORBIDDEN_GOLD_COLUMNS = frozenset(
    """
    source_patient_identifier synthetic_patient_name patient_id encounter_id
    observation_id condition_id medication_id medication_request_id
    medication_administration_id medication_dispense_id medication_statement_id
    procedure_id bronze_resource_id raw_json
    """.split()
)


def silver_table(name: str) -> SilverTable:
    try:
        return SILVER[name]
    except KeyError:
        raise ValueError(
            f"Unsupported Silver table: {name}. Use: {', '.join(SILVER)}"
        ) from None


def gold_table(name: str) -> GoldTable:
    try:
        return GOLD[name]
    except KeyError:
        raise ValueError(
            f"Unsupported Gold table: {name}. Use: {', '.join(GOLD)}"
        ) from None
