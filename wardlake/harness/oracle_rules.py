"""What the privacy oracles expect, written out without the engine's own lists."""

from __future__ import annotations

# Table, column, classification, publishable by default, rationale.
EXPECTED_RULES = (
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
# Every Silver table, and the columns of lineage each of them has.
EXPECTED_TABLES = (
    "patient",
    "encounter",
    "observation",
    "condition",
    "medication",
    "medication_ingredient",
    "medication_request",
    "medication_administration",
    "medication_dispense",
    "medication_statement",
    "procedure",
)
EXPECTED_LINEAGE = (
    "source_file",
    "resource_family",
    "profile_url",
    "source_dataset_name",
    "source_dataset_version",
    "bronze_ingested_at",
    "bronze_resource_id",
)
EXPECTED_LINEAGE_KIND = "lineage_metadata"
EXPECTED_LINEAGE_TEXT = (
    "Operational lineage column for traceability, not a Gold presentation field."
)

# Patterns of identifier-like text and the columns they are run on.
EXPECTED_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "phone": r"\b(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s])\d{3}[-.\s]\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "ipv4": (
        r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"
    ),
    "url": r"\bhttps?://[^\s]+",
}
EXPECTED_SCOPE = {
    "patient": ("source_patient_identifier", "synthetic_patient_name",),
    "encounter": ("admit_source", "discharge_disposition",),
    "observation": ("display", "value",),
    "condition": ("display",),
    "medication": ("medication_display", "medication_text",),
    "medication_request": ("medication_display",),
    "medication_administration": ("medication_display",),
    "medication_dispense": ("medication_display", "medication_text",),
    "medication_statement": ("medication_display", "medication_text",),
    "procedure": ("procedure_display", "body_site_display",),
}
