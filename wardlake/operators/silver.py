"""Silver: flat relational tables, one parse per resource, native expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import fhir
from wardlake.functions.scalars import filled_or
from wardlake.operators.lookups import left_lookup
from wardlake.plans.registry import SILVER_TABLES, silver_table
from wardlake.sources.bronze import bronze_records
from wardlake.sources.tables import as_layout



class _Resource:
    """The parsed resource column ``r``; nodes are looked up when asked for."""

    def getField(self, name: str) -> Column:  # noqa: N802 - same as Column
        return F.col("r").getField(name)

    __getitem__ = getField


R = _Resource()


def lineage() -> list[Column]:
    """Bronze origin of a row, appended to every Silver table."""
    return [
        F.col("source_file"),
        F.col("resource_family"),
        F.col("profile_url"),
        F.col("source_dataset_name"),
        F.col("source_dataset_version"),
        F.col("ingested_at").alias("bronze_ingested_at"),
        F.col("resource_id").alias("bronze_resource_id"),
    ]


def parsed(bronze: DataFrame, resource_type: str) -> DataFrame:
    """Bronze records of one type with the resource as the typed struct ``r``."""
    return bronze_records(bronze, resource_type).withColumn(
        "r", fhir.parse_resource(F.col("raw_json"), resource_type)
    )


def with_first_dosage(rows: DataFrame) -> DataFrame:
    """Adds the first dosage instruction, parsed once for all its fields."""
    return rows.withColumn("first_dosage", fhir.first_dosage(R["dosageInstruction"]))


def _flat(rows: DataFrame, name: str, **columns: Column) -> DataFrame:
    table = rows.select(*[c.alias(n) for n, c in columns.items()], *lineage())
    return as_layout(table, silver_table(name).schema)


def patient(bronze: DataFrame) -> DataFrame:
    def extension(url: str) -> Column:
        return fhir.extension_text(fhir.extension_by_url(R["extension"], url))

    return _flat(
        parsed(bronze, "Patient"),
        "patient",
        patient_id=R["id"],
        source_patient_identifier=fhir.first_identifier_value(R["identifier"]),
        synthetic_patient_name=fhir.first_family_name(R["name"]),
        gender=R["gender"],
        birth_date=R["birthDate"],
        deceased_datetime=R["deceasedDateTime"],
        race=extension(fhir.RACE_URL),
        ethnicity=extension(fhir.ETHNICITY_URL),
        birth_sex=extension(fhir.BIRTH_SEX_URL),
        marital_status_code=fhir.first_coding(R["maritalStatus"])["code"],
    )


def encounter(bronze: DataFrame) -> DataFrame:
    stay = R["hospitalization"]
    discharge = fhir.first_coding(stay["dischargeDisposition"])
    period = fhir.period_fields(R["period"])
    return _flat(
        parsed(bronze, "Encounter"),
        "encounter",
        encounter_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        status=R["status"],
        class_code=R["class"]["code"],
        class_display=R["class"]["display"],
        start_datetime=period["start"],
        end_datetime=period["end"],
        service_type_code=fhir.first_coding(R["serviceType"])["code"],
        admit_source=fhir.first_coding(stay["admitSource"])["code"],
        discharge_disposition=discharge["code"],
        discharge_disposition_display=discharge["display"],
    )


def observation(bronze: DataFrame) -> DataFrame:
    category = fhir.coding_fields(fhir.first_coding_in_list(R["category"]))
    code = fhir.coding_fields(fhir.first_coding(R["code"]))
    value = fhir.observation_value(R)
    return _flat(
        parsed(bronze, "Observation"),
        "observation",
        observation_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["encounter"]),
        status=R["status"],
        effective_datetime=R["effectiveDateTime"],
        issued_datetime=R["issued"],
        category_code=category["code"],
        category_system=category["system"],
        category_display=category["display"],
        code=code["code"],
        code_system=code["system"],
        display=code["display"],
        value_type=value["value_type"],
        value=value["value"],
        unit=value["unit"],
        specimen_id=fhir.reference_id(R["specimen"]),
    )


def condition(bronze: DataFrame) -> DataFrame:
    category = fhir.coding_fields(fhir.first_coding_in_list(R["category"]))
    code = fhir.coding_fields(fhir.first_coding(R["code"]))
    return _flat(
        parsed(bronze, "Condition"),
        "condition",
        condition_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["encounter"]),
        category_code=category["code"],
        category_system=category["system"],
        category_display=category["display"],
        code=code["code"],
        code_system=code["system"],
        display=code["display"],
    )


def medication(bronze: DataFrame) -> DataFrame:
    concept = fhir.concept_fields(R["code"])
    form = fhir.coding_fields(fhir.first_coding(R["form"]))
    name = fhir.identifier_value_for(R["identifier"], fhir.MEDICATION_NAME_SYSTEM)
    ingredients = fhir.list_length(R["ingredient"])
    return _flat(
        parsed(bronze, "Medication"),
        "medication",
        medication_id=R["id"],
        medication_code=concept["code"],
        medication_code_system=concept["system"],
        medication_display=filled_or(concept["display"], name),
        medication_text=concept["text"],
        form_code=form["code"],
        form_display=form["display"],
        is_mix=F.coalesce(F.col("resource_family") == fhir.MIX_FAMILY, F.lit(False)) | (ingredients > 0),
        identifier_count=fhir.list_length(R["identifier"]),
        ingredient_count=ingredients,
    )


def medication_ingredient(bronze: DataFrame) -> DataFrame:
    """One row per ingredient object; the position counts every list element."""
    exploded = (
        parsed(bronze, "Medication")
        .select("*", F.posexplode(R["ingredient"]).alias("position", "item"))
        .filter(F.startswith("item", F.lit("{")))
        .withColumn("i", F.from_json("item", fhir.INGREDIENT))
    )
    item = F.col("i")
    concept = fhir.concept_fields(item["itemCodeableConcept"])
    numerator = fhir.quantity_fields(item["strength"]["numerator"])
    denominator = fhir.quantity_fields(item["strength"]["denominator"])
    return _flat(
        exploded,
        "medication_ingredient",
        medication_id=R["id"],
        ingredient_index=F.col("position"),
        ingredient_medication_id=fhir.reference_id(item["itemReference"]),
        ingredient_code=concept["code"],
        ingredient_code_system=concept["system"],
        ingredient_display=concept["display"],
        strength_numerator_value=numerator["value"],
        strength_numerator_unit=numerator["unit"],
        strength_denominator_value=denominator["value"],
        strength_denominator_unit=denominator["unit"],
    )


def medication_catalogue(medications: DataFrame) -> DataFrame:
    """One row per medication id. Repeated ids: the greatest origin wins whole."""
    entry = F.struct(
        "source_file",
        "medication_code",
        "medication_code_system",
        "medication_display",
    )
    return (
        medications.filter(F.col("medication_id").isNotNull())
        .groupBy("medication_id")
        .agg(F.max(entry).alias("entry"))
        .select(
            "medication_id",
            F.col("entry.medication_code").alias("catalogue_code"),
            F.col("entry.medication_code_system").alias("catalogue_system"),
            F.col("entry.medication_display").alias("catalogue_display"),
        )
    )


def medication_request(bronze: DataFrame, medications: DataFrame) -> DataFrame:
    """Orders; an empty inline concept field is filled from the catalogue.

    Rows are flattened before the lookup, so only flat columns can be shuffled.
    """
    concept = fhir.concept_fields(R["medicationCodeableConcept"])
    medication_id = fhir.reference_id(R["medicationReference"])
    rows = with_first_dosage(parsed(bronze, "MedicationRequest"))
    dosage = fhir.dosage_summary(F.col("first_dosage"))
    validity = fhir.period_fields(R["dispenseRequest"]["validityPeriod"])
    by_reference = F.nullif(medication_id, F.lit("")).isNotNull()
    inline = _flat(
        rows,
        "medication_request",
        medication_request_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["encounter"]),
        status=R["status"],
        intent=R["intent"],
        authored_datetime=R["authoredOn"],
        medication_id=medication_id,
        medication_code=concept["code"],
        medication_code_system=concept["system"],
        medication_display=concept["display"],
        medication_source_type=F.when(by_reference, "reference").otherwise(
            "inline_code"
        ),
        route_code=dosage["route_code"],
        route_display=dosage["route_display"],
        dose_value=dosage["dose_value"],
        dose_unit=dosage["dose_unit"],
        frequency=dosage["frequency"],
        period=dosage["period"],
        period_unit=dosage["period_unit"],
        validity_start_datetime=validity["start"],
        validity_end_datetime=validity["end"],
        dosage_instruction_count=fhir.list_length(R["dosageInstruction"]),
    )
    filled = left_lookup(inline, medication_catalogue(medications), "medication_id")
    return as_layout(
        filled.withColumns(
            {
                column: filled_or(F.col(column), F.col(catalogue))
                for column, catalogue in (
                    ("medication_code", "catalogue_code"),
                    ("medication_code_system", "catalogue_system"),
                    ("medication_display", "catalogue_display"),
                )
            }
        ),
        silver_table("medication_request").schema,
    )


def medication_administration(bronze: DataFrame) -> DataFrame:
    category = fhir.coding_fields(fhir.first_coding(R["category"]))
    concept = fhir.concept_fields(R["medicationCodeableConcept"])
    window = fhir.effective_window(R)
    dosage = fhir.administration_dosage(R["dosage"])
    request_id = fhir.reference_id(R["request"])
    encounter_id = fhir.reference_id(R["context"])
    return _flat(
        parsed(bronze, "MedicationAdministration"),
        "medication_administration",
        medication_administration_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=encounter_id,
        status=R["status"],
        category_code=category["code"],
        category_display=category["display"],
        effective_start_datetime=window["start"],
        effective_end_datetime=window["end"],
        medication_code=concept["code"],
        medication_code_system=concept["system"],
        medication_display=concept["display"],
        medication_request_id=request_id,
        dose_value=dosage["dose_value"],
        dose_unit=dosage["dose_unit"],
        method_code=dosage["method_code"],
        method_display=dosage["method_display"],
        source_system=fhir.source_system(
            F.col("resource_family"), fhir.ADMINISTRATION_FAMILIES, "hospital"
        ),
        has_request_reference=request_id.isNotNull(),
        has_encounter_context=encounter_id.isNotNull(),
    )


def medication_dispense(bronze: DataFrame) -> DataFrame:
    concept = fhir.concept_fields(R["medicationCodeableConcept"])
    rows = with_first_dosage(parsed(bronze, "MedicationDispense")).withColumn(
        "requests", fhir.reference_ids(R["authorizingPrescription"])
    )
    dosage = fhir.dosage_summary(F.col("first_dosage"))
    return _flat(
        rows,
        "medication_dispense",
        medication_dispense_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["context"]),
        status=R["status"],
        when_handed_over_datetime=R["whenHandedOver"],
        medication_code=concept["code"],
        medication_code_system=concept["system"],
        medication_display=concept["display"],
        medication_text=concept["text"],
        medication_request_id=F.get("requests", F.lit(0)),
        authorizing_prescription_count=fhir.list_length(R["authorizingPrescription"]),
        route_code=dosage["route_code"],
        route_display=dosage["route_display"],
        frequency=dosage["frequency"],
        period=dosage["period"],
        period_unit=dosage["period_unit"],
        source_system=fhir.source_system(F.col("resource_family"), fhir.DISPENSE_FAMILIES, "inpatient"),
        has_request_reference=F.size("requests") > 0,
    )


def medication_statement(bronze: DataFrame) -> DataFrame:
    concept = fhir.concept_fields(R["medicationCodeableConcept"])
    return _flat(
        parsed(bronze, "MedicationStatement"),
        "medication_statement",
        medication_statement_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["context"]),
        status=R["status"],
        date_asserted_datetime=R["dateAsserted"],
        medication_code=concept["code"],
        medication_code_system=concept["system"],
        medication_display=concept["display"],
        medication_text=concept["text"],
        source_system=F.lit("ed"),
    )


def procedure(bronze: DataFrame) -> DataFrame:
    category = fhir.coding_fields(fhir.first_coding(R["category"]))
    concept = fhir.concept_fields(R["code"])
    body_site = fhir.coding_fields(fhir.first_coding_in_list(R["bodySite"]))
    window = fhir.effective_window(R)
    return _flat(
        parsed(bronze, "Procedure"),
        "procedure",
        procedure_id=R["id"],
        patient_id=fhir.reference_id(R["subject"]),
        encounter_id=fhir.reference_id(R["encounter"]),
        status=R["status"],
        performed_start_datetime=window["start"],
        performed_end_datetime=window["end"],
        category_code=category["code"],
        category_display=category["display"],
        procedure_code=concept["code"],
        procedure_code_system=concept["system"],
        procedure_display=concept["display"],
        body_site_code=body_site["code"],
        body_site_display=body_site["display"],
        source_system=fhir.source_system(F.col("resource_family"), fhir.PROCEDURE_FAMILIES, "hospital"),
    )


_BUILDERS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "patient": patient,
    "encounter": encounter,
    "observation": observation,
    "condition": condition,
    "medication": medication,
    "medication_ingredient": medication_ingredient,
    "medication_administration": medication_administration,
    "medication_dispense": medication_dispense,
    "medication_statement": medication_statement,
    "procedure": procedure,
}


def build_silver(
    name: str, bronze: DataFrame, medications: DataFrame | None = None
) -> DataFrame:
    """One Silver table by name.

    ``medication_request`` looks names up in the medication table; pass the
    written one, else it is derived from the same Bronze.
    """
    silver_table(name)
    if name == "medication_request":
        source = medications if medications is not None else medication(bronze)
        return medication_request(bronze, source)
    return _BUILDERS[name](bronze)


def build_all_silver(bronze: DataFrame) -> dict[str, DataFrame]:
    """All eleven tables in dependency order."""
    return {table.name: build_silver(table.name, bronze) for table in SILVER_TABLES}
