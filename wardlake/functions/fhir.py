"""FHIR field extraction as Column expressions over a once-parsed resource.

Every function takes Columns of a ``from_json`` struct and returns null when the
node is absent or of another shape. Nodes that may be an object or bare text
(references) are read as strings: the JSON reader hands back an object's text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.functions.scalars import filled_or, number_text, reference_tail

CODING = "struct<code:string,system:string,display:string>"
CONCEPT = f"struct<coding:array<{CODING}>,text:string>"
QUANTITY = "struct<value:string,unit:string,code:string>"
PERIOD = "struct<start:string,end:string>"
EXTENSION = (
    "struct<url:string,valueString:string,valueCode:string,"
    "extension:array<struct<url:string,valueString:string>>>"
)
DOSAGE = (
    f"struct<route:{CONCEPT},doseAndRate:array<struct<doseQuantity:{QUANTITY}>>,"
    f"dose:{QUANTITY},timing:struct<"
    "repeat:struct<frequency:string,period:string,periodUnit:string>,"
    f"code:{CONCEPT}>>"
)
INGREDIENT = (
    f"struct<itemReference:string,itemCodeableConcept:{CONCEPT},"
    f"strength:struct<numerator:{QUANTITY},denominator:{QUANTITY}>>"
)

# One schema per resource type: exactly the nodes the flat tables need, so a
# resource is parsed once and unread nodes are skipped by the parser.
RESOURCE_SCHEMAS = {
    "Patient": (
        "struct<id:string,identifier:array<string>,"
        "name:array<struct<family:string>>,gender:string,birthDate:string,"
        f"deceasedDateTime:string,extension:array<{EXTENSION}>,"
        f"maritalStatus:{CONCEPT}>"
    ),
    "Encounter": (
        f"struct<id:string,subject:string,status:string,class:{CODING},"
        f"period:{PERIOD},serviceType:{CONCEPT},hospitalization:struct<"
        f"admitSource:{CONCEPT},dischargeDisposition:{CONCEPT}>>"
    ),
    "Observation": (
        "struct<id:string,subject:string,encounter:string,specimen:string,"
        "status:string,effectiveDateTime:string,issued:string,"
        f"category:array<{CONCEPT}>,code:{CONCEPT},valueQuantity:{QUANTITY},"
        "valueString:string,component:string>"
    ),
    "Condition": (
        "struct<id:string,subject:string,encounter:string,"
        f"category:array<{CONCEPT}>,code:{CONCEPT}>"
    ),
    "Medication": (
        f"struct<id:string,code:{CONCEPT},form:{CONCEPT},"
        "identifier:array<string>,ingredient:array<string>>"
    ),
    "MedicationRequest": (
        "struct<id:string,subject:string,encounter:string,status:string,"
        "intent:string,authoredOn:string,medicationReference:string,"
        f"medicationCodeableConcept:{CONCEPT},dosageInstruction:array<string>,"
        f"dispenseRequest:struct<validityPeriod:{PERIOD}>>"
    ),
    "MedicationAdministration": (
        "struct<id:string,subject:string,context:string,request:string,"
        "status:string,effectiveDateTime:string,performedDateTime:string,"
        f"effectivePeriod:{PERIOD},performedPeriod:{PERIOD},category:{CONCEPT},"
        f"medicationCodeableConcept:{CONCEPT},"
        f"dosage:struct<dose:{QUANTITY},method:{CONCEPT}>>"
    ),
    "MedicationDispense": (
        "struct<id:string,subject:string,context:string,status:string,"
        f"whenHandedOver:string,medicationCodeableConcept:{CONCEPT},"
        "authorizingPrescription:array<string>,dosageInstruction:array<string>>"
    ),
    "MedicationStatement": (
        "struct<id:string,subject:string,context:string,status:string,"
        f"dateAsserted:string,medicationCodeableConcept:{CONCEPT}>"
    ),
    "Procedure": (
        "struct<id:string,subject:string,encounter:string,status:string,"
        "effectiveDateTime:string,performedDateTime:string,"
        f"effectivePeriod:{PERIOD},performedPeriod:{PERIOD},category:{CONCEPT},"
        f"code:{CONCEPT},bodySite:array<{CONCEPT}>>"
    ),
}

# Extension addresses, identifier system and source families of
# the input data set.
RACE_URL = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"
ETHNICITY_URL = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity"
BIRTH_SEX_URL = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-birthsex"
MEDICATION_NAME_SYSTEM = (
    "http://mimic.mit.edu/fhir/mimic/CodeSystem/mimic-medication-name"
)
MIX_FAMILY = "MimicMedicationMix"
ADMINISTRATION_FAMILIES = {"MimicMedicationAdministrationICU": "icu"}
DISPENSE_FAMILIES = {"MimicMedicationDispenseED": "ed"}
PROCEDURE_FAMILIES = {"MimicProcedureED": "ed", "MimicProcedureICU": "icu"}


def parse_resource(raw_json: Column, resource_type: str) -> Column:
    """The whole resource as one typed struct (a single JSON pass per row)."""
    return F.from_json(raw_json, RESOURCE_SCHEMAS[resource_type])


# --- references -----------------------------------------------------------


def reference_id(node: Column) -> Column:
    """Id of a reference node: an object's ``reference`` or bare text."""
    target = (
        F.when(F.startswith(node, F.lit("{")), F.get_json_object(node, "$.reference"))
        .when(F.startswith(node, F.lit("[")), F.lit(None))
        .otherwise(node)
    )
    return reference_tail(target)


def reference_ids(nodes: Column) -> Column:
    """All readable ids of a reference list, in order (empty when absent)."""
    ids = F.filter(F.transform(nodes, reference_id), lambda i: i.isNotNull())
    return F.coalesce(ids, F.array().cast("array<string>"))


# --- identifiers, names, codings ------------------------------------------


def first_identifier_value(identifiers: Column) -> Column:
    return F.get_json_object(F.get(identifiers, F.lit(0)), "$.value")


def identifier_value_for(identifiers: Column, system: str) -> Column:
    """Value of the first identifier carrying the given system."""
    same_system = F.filter(
        identifiers, lambda i: F.get_json_object(i, "$.system") == system
    )
    return F.get_json_object(F.get(same_system, F.lit(0)), "$.value")


def first_family_name(names: Column) -> Column:
    return F.get(names, F.lit(0)).getField("family")


def first_coding(concept: Column) -> Column:
    return F.get(concept.getField("coding"), F.lit(0))


def first_coding_in_list(concepts: Column) -> Column:
    return first_coding(F.get(concepts, F.lit(0)))


def coding_fields(coding: Column) -> Column:
    """code, system and display of one coding, without any text fallback."""
    return F.struct(
        coding.getField("code").alias("code"),
        coding.getField("system").alias("system"),
        coding.getField("display").alias("display"),
    )


def concept_fields(concept: Column) -> Column:
    """code, system, display (text when there is none) and text of a concept."""
    coding = first_coding(concept)
    text = concept.getField("text")
    return F.struct(
        coding.getField("code").alias("code"),
        coding.getField("system").alias("system"),
        filled_or(coding.getField("display"), text).alias("display"),
        text.alias("text"),
    )


# --- extensions -----------------------------------------------------------


def extension_by_url(extensions: Column, url: str) -> Column:
    return F.get(F.filter(extensions, lambda e: e.getField("url") == url), F.lit(0))


def extension_text(extension: Column) -> Column:
    """Nested ``text`` value if such a part exists, else the direct value."""
    texts = F.filter(
        extension.getField("extension"), lambda e: e.getField("url") == "text"
    )
    direct = filled_or(
        extension.getField("valueString"), extension.getField("valueCode")
    )
    return F.when(
        F.size(texts) > 0, F.get(texts, F.lit(0)).getField("valueString")
    ).otherwise(direct)


# --- quantities, periods, values ------------------------------------------


def quantity_fields(quantity: Column) -> Column:
    """Value text and unit (code when the unit is empty) of a quantity."""
    return F.struct(
        number_text(quantity.getField("value")).alias("value"),
        filled_or(quantity.getField("unit"), quantity.getField("code")).alias("unit"),
    )


def period_fields(period: Column) -> Column:
    return F.struct(
        period.getField("start").alias("start"), period.getField("end").alias("end")
    )


def effective_window(resource: Column) -> Column:
    """Start and end of an event: a point in time wins over a period."""

    def window(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"))

    no_end = F.lit(None).cast("string")
    effective = resource.getField("effectivePeriod")
    performed = resource.getField("performedPeriod")
    point = F.coalesce(
        resource.getField("effectiveDateTime"), resource.getField("performedDateTime")
    )
    bounded = effective.getField("start").isNotNull() | effective.getField(
        "end"
    ).isNotNull()
    return (
        F.when(point.isNotNull(), window(point, no_end))
        .when(bounded, window(effective.getField("start"), effective.getField("end")))
        .otherwise(window(performed.getField("start"), performed.getField("end")))
    )


def observation_value(resource: Column) -> Column:
    """Kind, text and unit of an observation's result."""
    nothing = F.lit(None).cast("string")
    source = resource.getField("valueQuantity")
    quantity = quantity_fields(source)
    text = resource.getField("valueString")
    component = F.regexp_replace(resource.getField("component"), r"\s", "")

    def value(kind: str | None, content: Column, unit: Column) -> Column:
        return F.struct(
            F.lit(kind).cast("string").alias("value_type"),
            content.alias("value"),
            unit.alias("unit"),
        )

    return (
        F.when(
            source.getField("value").isNotNull(),
            value("quantity", quantity.getField("value"), quantity.getField("unit")),
        )
        .when(text.isNotNull(), value("string", text, nothing))
        .when(
            component.isNotNull()
            & ~component.isin("", "[]", "{}", "0", "0.0", "false"),
            value("component", nothing, nothing),
        )
        .otherwise(value(None, nothing, nothing))
    )


# --- dosage ---------------------------------------------------------------


def first_dosage(dosages: Column) -> Column:
    return F.from_json(F.get(dosages, F.lit(0)), DOSAGE)


def dosage_dose(dosage: Column) -> Column:
    """Dose of a dosage: the first dose-and-rate entry, if any, decides alone."""
    entry = F.get(dosage.getField("doseAndRate"), F.lit(0))
    return F.when(
        entry.isNotNull(), quantity_fields(entry.getField("doseQuantity"))
    ).otherwise(quantity_fields(dosage.getField("dose")))


def dosage_summary(dosage: Column) -> Column:
    route = first_coding(dosage.getField("route"))
    dose = dosage_dose(dosage)
    timing = dosage.getField("timing")
    repeat = timing.getField("repeat")
    timing_code = first_coding(timing.getField("code")).getField("code")
    return F.struct(
        route.getField("code").alias("route_code"),
        route.getField("display").alias("route_display"),
        dose.getField("value").alias("dose_value"),
        dose.getField("unit").alias("dose_unit"),
        filled_or(number_text(repeat.getField("frequency")), timing_code).alias(
            "frequency"
        ),
        number_text(repeat.getField("period")).alias("period"),
        repeat.getField("periodUnit").alias("period_unit"),
    )


def administration_dosage(dosage: Column) -> Column:
    dose = quantity_fields(dosage.getField("dose"))
    method = first_coding(dosage.getField("method"))
    return F.struct(
        dose.getField("value").alias("dose_value"),
        dose.getField("unit").alias("dose_unit"),
        method.getField("code").alias("method_code"),
        method.getField("display").alias("method_display"),
    )


# --- lists and lineage ----------------------------------------------------


def list_length(items: Column) -> Column:
    """Length of a JSON list, 0 when the node is not a list."""
    return F.coalesce(F.size(items), F.lit(0)).cast("bigint")


def source_system(family: Column, by_family: dict[str, str], default: str) -> Column:
    system = F.lit(default)
    for name, label in by_family.items():
        system = F.when(family == name, F.lit(label)).otherwise(system)
    return system
