"""FHIR-shaped source resources derived from the star-schema test tables.

Every resource type is a plain projection (with key joins) of the given tables,
rendered as JSON text. Key arithmetic varies the shapes: absent nodes, bare text
references, empty texts, wrong node types, exponent numbers, dangling keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions.fhir import (
    BIRTH_SEX_URL,
    ETHNICITY_URL,
    MEDICATION_NAME_SYSTEM,
    RACE_URL,
)
from wardlake.operators.gold import VITAL_DISPLAYS
from wardlake.sources.bronze import bronze_rows

DATASET_NAME = "star-schema-clinic"
DATASET_VERSION = "1.0"
INGESTED_AT = "2024-01-01T00:00:00+00:00"
PROFILE_ROOT = "http://example.org/fhir/StructureDefinition/"


# --- JSON text helpers ----------------------------------------------------


def text(value: Column | str) -> Column:
    """A JSON string of a value without characters to escape."""
    content = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit('"'), content, F.lit('"'))


def obj(**nodes: Column | None) -> Column:
    """A JSON object; nodes that are null are left out. ``class_`` is ``class``."""
    parts = [
        F.concat(F.lit(f'"{name.rstrip("_")}":'), node)
        for name, node in nodes.items()
        if node is not None
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def arr(*nodes: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *nodes), F.lit("]"))


def cat(*parts: Column | str) -> Column:
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    )


def every(key: Column, modulus: int, rest: int = 0) -> Column:
    return key % modulus == rest


def unless(condition: Column, node: Column) -> Column:
    return F.when(~condition, node)


def ref(kind: str, key: Column) -> Column:
    return obj(reference=text(cat(f"{kind}/", key)))


def concept(text_node: Column | None = None, **coding: Column | None) -> Column:
    return obj(coding=arr(obj(**coding)), text=text_node)


def iso(ts: Column, offset: str = "") -> Column:
    stamp = F.replace(F.substring(ts.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    return F.concat(stamp, F.lit(offset))


def shifted(ts: Column, hours: Column, minutes: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, hours, minutes, zero.cast("decimal(18,6)"))


def resource(
    df: DataFrame, kind: str, family: Column | str, no_profile: Column | None = None, **nodes
) -> DataFrame:
    profile = arr(text(PROFILE_ROOT + kind.lower()))
    meta = obj(profile=profile)
    if no_profile is not None:
        meta = unless(no_profile, meta)
    return df.select(
        F.lit(kind).alias("resource_type"),
        cat(family, ".ndjson.gz").alias("source_file"),
        obj(resourceType=text(kind), meta=meta, **nodes).alias("value"),
    )


def pick(options: dict[int, str], key: Column, default: str) -> Column:
    chosen = F.lit(default)
    for value, label in options.items():
        chosen = F.when(key == value, F.lit(label)).otherwise(chosen)
    return chosen


# --- tables ---------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_with_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_id(prefix: str) -> Column:
    return text(cat(f"{prefix}-", F.concat_ws("-", *[F.col(c) for c in LINE_KEY])))


# --- resources ------------------------------------------------------------


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    race = obj(
        url=text(RACE_URL),
        extension=arr(
            obj(url=text("ombCategory"), valueString=text("x")),
            obj(url=text("text"), valueString=unless(every(k, 7), text(F.col("n_name")))),
        ),
    )
    ethnicity = F.when(
        every(k, 5),
        obj(
            url=text(ETHNICITY_URL),
            extension=arr(obj(url=text("text"), valueString=text(F.col("r_name")))),
        ),
    ).otherwise(
        obj(
            url=text(ETHNICITY_URL),
            valueString=text(""),
            valueCode=text(cat("E", F.col("r_regionkey"))),
        )
    )
    sex = unless(
        every(k, 29),
        obj(
            url=text(BIRTH_SEX_URL),
            valueCode=text(F.when(every(k, 2), "M").otherwise("F")),
        ),
    )
    birth = F.date_add(F.lit("1930-01-01").cast("date"), (k * 37 % 30000).cast("int"))
    return resource(
        rows,
        "Patient",
        "MimicPatient",
        id=text(cat("c-", k)),
        identifier=unless(
            every(k, 13),
            arr(
                obj(
                    system=text("s"),
                    value=F.when(every(k, 17), k.cast("string")).otherwise(text(k)),
                )
            ),
        ),
        name=F.when(every(k, 19), arr()).otherwise(arr(obj(family=text(F.col("c_name"))))),
        gender=F.when(every(k, 3), text("male")).when(every(k, 3, 1), text("female")),
        birthDate=text(birth),
        deceasedDateTime=F.when(every(k, 23), text("2020-01-01T00:00:00-05:00")),
        extension=F.when(every(k, 31), F.lit("{}")).otherwise(arr(race, ethnicity, sex)),
        maritalStatus=F.when(every(k, 37), obj(text=text("x"))).otherwise(
            concept(code=text(F.col("c_mktsegment")))
        ),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, cust = F.col("o_orderkey"), cat("c-", F.col("o_custkey"))
    start = shifted(F.col("o_orderdate"), (k % 24).cast("int"), (k % 60).cast("int"))
    end = shifted(
        F.col("start"), (F.col("o_custkey") % 200).cast("int"), (k % 90).cast("int")
    )
    # Steps of their own: as one, the method is too large for the JVM to compile.
    rows = table(spark, sf_dir, "orders").withColumn("start", start)
    rows = rows.select("*", iso(F.col("start")).alias("begun"), iso(end).alias("ended"))
    begun, ended = F.col("begun"), F.col("ended")
    subject = (
        F.when(every(k, 31), text(cat("Patient/", cust)))
        .when(every(k, 37), arr(text(cat("Patient/", cust))))
        .when(every(k, 41), obj(reference=text(cust)))
        .when(every(k, 47), obj(reference=text("Patient/")))
        .otherwise(ref("Patient", cust))
    )
    start_text = (
        F.when(every(k, 101, 7), F.lit("unknown"))
        .when(every(k, 103, 5), F.substring(begun, 1, 7))
        .when(every(k, 107, 3), F.substring(begun, 1, 10))
        .otherwise(cat(begun, "-04:00"))
    )
    end_text = (
        F.when(every(k, 17), F.lit(None))
        .when(every(k, 109, 1), cat(F.substring(ended, 1, 10), "T24:00:00"))
        .otherwise(cat(ended, "-04:00"))
    )
    status = F.col("o_orderstatus")
    return resource(
        rows,
        "Encounter",
        pick({0: "MimicEncounterED", 1: "MimicEncounterICU"}, k % 10, "MimicEncounter"),
        id=text(cat("o-", k)),
        subject=subject,
        status=text(
            F.when(status == "F", "finished")
            .when(status == "O", "in-progress")
            .otherwise("planned")
        ),
        class_=unless(
            every(k, 29),
            obj(
                code=text(F.col("o_orderpriority")),
                display=text(F.lower("o_orderpriority")),
            ),
        ),
        period=unless(every(k, 113), obj(start=text(start_text), end=text(end_text))),
        serviceType=F.when(every(k, 59), text("text")).otherwise(
            concept(code=text(cat("S", k % 5)))
        ),
        hospitalization=F.when(every(k, 53), text("n/a")).otherwise(
            obj(
                admitSource=concept(code=text(cat("A", k % 4))),
                dischargeDisposition=concept(
                    code=unless(every(k, 10, 3), text(cat("D-", status))),
                    display=text(cat("Disposition ", status)),
                ),
            )
        ),
    )


def line_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    number = F.col("l_linenumber")
    lab = F.col("l_returnflag") == "A"
    when = shifted(F.col("l_shipdate"), (part % 24).cast("int"), F.lit(0))
    vital = F.element_at(F.array(*[F.lit(v) for v in VITAL_DISPLAYS]), number % 7 + 1)
    unit = F.when(
        lab, F.when(every(number, 3), "mg/dL").otherwise("mmol/L")
    ).otherwise(cat("u", number % 7))
    as_text = every(part, 71) | every(part, 73)
    return resource(
        lines_with_patient(spark, sf_dir),
        "Observation",
        F.when(lab, "MimicObservationLabevents").otherwise(
            "MimicObservationChartevents"
        ),
        id=line_id("l"),
        subject=ref(
            "Patient",
            cat(F.when(every(part, 89), "x-").otherwise("c-"), F.col("o_custkey")),
        ),
        encounter=unless(
            every(part, 13),
            ref("Encounter", cat(F.when(every(part, 97), "z-").otherwise("o-"), order)),
        ),
        specimen=F.when(lab, ref("Specimen", cat("s-", supp))),
        status=text("final"),
        effectiveDateTime=unless(every(part, 83), text(iso(when, "-05:00"))),
        issued=text(F.substring(iso(when), 1, 10)),
        category=arr(
            concept(
                code=text(
                    F.when(~lab, "vital-signs")
                    .when(every(number, 2), "laboratory")
                    .otherwise("Labs")
                ),
                system=text("cat-sys"),
                display=text(F.when(lab, "Laboratory").otherwise("Vital Signs")),
            )
        ),
        code=concept(
            code=text(F.when(lab, cat("L", supp % 20)).otherwise(cat("V", number % 7))),
            system=text("obs-sys"),
            display=text(F.when(lab, cat("Lab test ", supp % 20)).otherwise(vital)),
        ),
        valueQuantity=unless(
            as_text, obj(value=F.col("l_quantity").cast("string"), unit=text(unit))
        ),
        valueString=F.when(every(part, 71), text("not numeric")).when(
            every(part, 73), text("12.5")
        ),
    )


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("event_id"), F.col("event_type")
    shape = k % 8
    fixed = F.col("value").cast("decimal(20,2)")
    number = (
        F.when(shape == 1, cat(fixed, "E7"))
        .when(shape == 2, cat(fixed, "e-5"))
        .when(shape == 3, F.col("value").cast("bigint").cast("string"))
        .when(shape.isin(0, 7), fixed.cast("string"))
    )
    return resource(
        table(spark, sf_dir, "events").filter(kind.isin("error", "click")),
        "Observation",
        "MimicObservationVitalSignsED",
        id=text(cat("e-", k)),
        subject=ref("Patient", cat("c-", F.col("user_id"))),
        status=text("preliminary"),
        effectiveDateTime=text(iso(F.col("ts"))),
        category=F.when(kind == "click", arr(concept(code=text("exam")))),
        code=concept(display=text(cat("Event ", kind))),
        valueQuantity=unless(
            number.isNull(),
            obj(
                value=number,
                unit=text(F.when(shape == 7, "").otherwise("u")),
                code=text("mmHg"),
            ),
        ),
        valueString=F.when(shape == 4, text(cat("text ", k))),
        component=F.when(shape == 5, arr(obj(code=text("part")))).when(
            shape == 6, arr()
        ),
    )


def note_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    body = F.to_json(F.struct(F.col("text").alias("b")))
    quoted = F.substr(body, F.lit(6), F.length(body) - 6)
    return resource(
        table(spark, sf_dir, "documents"),
        "Observation",
        "MimicObservationNotes",
        id=text(cat("d-", k)),
        subject=F.when(every(k, 10), obj(display=text("none"))).otherwise(
            ref("Patient", cat("c-", k % 100))
        ),
        status=text("final"),
        code=concept(display=text("Note")),
        valueString=quoted,
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        line_observations(spark, sf_dir)
        .unionByName(event_observations(spark, sf_dir))
        .unionByName(note_observations(spark, sf_dir))
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        lines_with_patient(spark, sf_dir)
        .filter(F.col("l_linestatus") == "F")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return resource(
        rows,
        "Condition",
        F.when(every(F.col("l_linenumber"), 5), "MimicConditionED").otherwise(
            "MimicCondition"
        ),
        id=line_id("k"),
        subject=ref("Patient", cat("c-", F.col("o_custkey"))),
        encounter=unless(
            every(F.col("l_suppkey"), 50),
            ref("Encounter", cat("o-", F.col("l_orderkey"))),
        ),
        category=arr(concept(code=text("encounter-diagnosis"), system=text("cs"))),
        code=concept(
            text_node=text("t"),
            code=text(F.col("p_brand")),
            system=text("icd"),
            display=unless(every(F.col("p_size"), 10), text(F.col("p_type"))),
        ),
    )


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    display = F.when(every(k, 3), text(F.col("p_name"))).when(every(k, 3, 2), text(""))
    named = obj(system=text(MEDICATION_NAME_SYSTEM), value=text(F.col("p_name")))
    other = obj(system=text("other"), value=text("o"))
    part_of = cat(F.when(every(k, 61), "m-x").otherwise("m-"), k + 1)
    strength = obj(
        numerator=obj(value=size.cast("string"), unit=text("mg")),
        denominator=obj(value=F.lit("1.50"), unit=text(""), code=text("mL")),
    )
    first = obj(itemReference=ref("Medication", part_of), strength=strength)
    third = obj(
        itemCodeableConcept=concept(
            text_node=text(F.col("p_type")), code=text(F.col("p_brand"))
        )
    )
    return resource(
        table(spark, sf_dir, "part"),
        "Medication",
        F.when(every(size, 5) & every(k, 2), "MimicMedicationMix").otherwise(
            "MimicMedication"
        ),
        id=text(cat("m-", k)),
        code=unless(
            every(k, 50),
            concept(
                text_node=F.when(every(k, 6, 1), text(F.col("p_type"))),
                code=text(F.col("p_brand")),
                system=text("ndc"),
                display=display,
            ),
        ),
        form=concept(code=text(cat("F", size % 4)), display=text(cat("Form ", size % 4))),
        identifier=unless(
            every(k, 9), F.when(every(k, 8), arr(other)).otherwise(arr(other, named))
        ),
        ingredient=F.when(every(size, 10), arr(first, text("skip"), third)).when(
            every(size, 5), arr(first)
        ),
    )


def requests(spark: SparkSession, sf_dir: str, dangling: bool = True) -> DataFrame:
    k = F.col("o_orderkey")
    broken = every(k, 331) & F.lit(dangling)
    even = every(k, 2)
    drug = k % 40
    inline = (
        F.when(every(k, 4), concept(display=text("")))
        .when(even | every(k, 21), F.lit(None))
        .otherwise(
            concept(
                text_node=text(cat("Text ", drug)),
                code=text(cat("C", drug)),
                system=text("loc"),
                display=text(F.when(every(k, 6, 1), "").otherwise(cat("Drug ", drug))),
            )
        )
    )
    shape = k % 3
    price = F.col("o_totalprice").cast("decimal(20,2)").cast("string")
    dosage = obj(
        route=concept(code=text("IV"), display=text("Intravenous")),
        doseAndRate=F.when(
            shape == 0, arr(obj(doseQuantity=obj(value=price, unit=text("mg"))))
        ).when(shape == 2, arr(obj())),
        dose=obj(value=F.lit("9"), unit=text("x")),
        timing=obj(
            repeat=unless(
                shape == 0,
                obj(
                    frequency=(k % 4).cast("string"),
                    period=F.lit("1.5"),
                    periodUnit=text("d"),
                ),
            ),
            code=concept(code=text("BID")),
        ),
    )
    authored = F.when(every(k, 79), "2180").otherwise(
        iso(F.col("o_orderdate"), "-05:00")
    )
    return resource(
        table(spark, sf_dir, "orders"),
        "MedicationRequest",
        "MimicMedicationRequest",
        id=text(cat("r-", k)),
        subject=ref("Patient", cat("c-", F.col("o_custkey"))),
        encounter=unless(every(k, 23), ref("Encounter", cat("o-", k))),
        status=text(F.when(even, "completed").otherwise("active")),
        intent=text("order"),
        authoredOn=text(authored),
        medicationReference=F.when(
            even,
            ref(
                "Medication",
                F.when(broken, "m-x").otherwise(cat("m-", k % 200)),
            ),
        ),
        medicationCodeableConcept=inline,
        dosageInstruction=unless(every(k, 5), arr(dosage, obj())),
        dispenseRequest=unless(
            every(k, 7),
            obj(
                validityPeriod=obj(
                    start=text(iso(F.col("o_orderdate"))), end=text("2030-01-01")
                )
            ),
        ),
    )


def administrations(
    spark: SparkSession, sf_dir: str, dangling: bool = True
) -> DataFrame:
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    broken = every(part, 67) & F.lit(dangling)
    at = text(iso(F.col("l_shipdate"), "-05:00"))
    until = text(
        iso(shifted(F.col("l_shipdate"), F.lit(2), F.lit(30)), "-05:00")
    )
    dosage = obj(
        dose=obj(value=F.col("l_quantity").cast("string"), unit=text("mL")),
        method=concept(code=text("PUSH"), display=text("IV Push")),
    )
    rows = lines_with_patient(spark, sf_dir).filter(F.col("l_returnflag") == "A")
    return resource(
        rows,
        "MedicationAdministration",
        F.when(every(number, 4), "MimicMedicationAdministrationICU").otherwise(
            "MimicMedicationAdministration"
        ),
        id=line_id("a"),
        subject=ref("Patient", cat("c-", F.col("o_custkey"))),
        context=unless(
            every(part, 11), ref("Encounter", cat("o-", F.col("l_orderkey")))
        ),
        request=unless(
            every(part, 7),
            ref(
                "MedicationRequest",
                F.when(broken, "r-x").otherwise(
                    cat("r-", F.col("l_orderkey"))
                ),
            ),
        ),
        status=text("completed"),
        effectiveDateTime=F.when(every(number, 2, 1), at),
        performedDateTime=F.when(number == 6, at),
        effectivePeriod=F.when(number == 2, obj(start=at, end=until)),
        performedPeriod=F.when(number == 4, obj(end=until)),
        category=concept(code=text("inpatient"), display=text("Inpatient")),
        medicationCodeableConcept=unless(
            every(part, 59),
            concept(
                text_node=text(cat("Med ", part % 30)),
                code=text(cat("B", part % 30)),
                system=text("emar"),
            ),
        ),
        dosage=F.when(every(F.col("l_suppkey"), 9), arr(dosage)).otherwise(dosage),
    )


def dispenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    order = cat("r-", F.col("l_orderkey"))
    shape = part % 7
    dosage = obj(
        route=concept(code=text("PO"), display=text("Oral")),
        timing=obj(
            repeat=obj(
                frequency=number.cast("string"), period=F.lit("1"), periodUnit=text("h")
            )
        ),
    )
    rows = lines_with_patient(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    return resource(
        rows,
        "MedicationDispense",
        F.when(every(number, 5), "MimicMedicationDispenseED").otherwise(
            "MimicMedicationDispense"
        ),
        id=line_id("p"),
        subject=ref("Patient", cat("c-", F.col("o_custkey"))),
        context=unless(
            every(part, 10), ref("Encounter", cat("o-", F.col("l_orderkey")))
        ),
        status=text("completed"),
        whenHandedOver=text(iso(F.col("l_shipdate"), "-05:00")),
        medicationCodeableConcept=F.when(
            every(part, 3), obj(text=text(cat("Dispensed ", part % 20)))
        ).otherwise(
            concept(
                text_node=text(cat("Dispensed ", part % 20)),
                code=text(cat("N", part % 20)),
                system=text("ndc"),
                display=text(cat("Pill ", part % 20)),
            )
        ),
        authorizingPrescription=F.when(shape == 0, F.lit(None))
        .when(shape == 1, arr(text(cat("MedicationRequest/", order))))
        .when(shape == 2, arr(obj(display=text("x"))))
        .otherwise(arr(obj(display=text("x")), ref("MedicationRequest", order))),
        dosageInstruction=arr(dosage),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    drug = text(cat("Home med ", k % 25))
    rows = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return resource(
        rows,
        "MedicationStatement",
        "MimicMedicationStatementED",
        no_profile=every(k, 11),
        id=text(cat("s-", k)),
        subject=ref("Patient", cat("c-", F.col("user_id"))),
        context=unless(every(k, 2), ref("Encounter", cat("o-", k))),
        status=text("unknown"),
        dateAsserted=text(iso(F.col("ts"))),
        medicationCodeableConcept=F.when(
            every(k, 3), obj(coding=arr(), text=drug)
        ).otherwise(
            concept(
                text_node=drug,
                code=text(cat("H", k % 25)),
                system=text("gsn"),
                display=text(cat("Named ", k % 25)),
            )
        ),
    )


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("event_id"), F.col("event_type")
    at = text(iso(F.col("ts")))
    rows = table(spark, sf_dir, "events").filter(kind.isin("purchase", "signup"))
    return resource(
        rows,
        "Procedure",
        pick({0: "MimicProcedureED", 1: "MimicProcedureICU"}, k % 6, "MimicProcedure"),
        id=text(cat("q-", k)),
        subject=ref("Patient", cat("c-", F.col("user_id"))),
        encounter=unless(every(k, 500), ref("Encounter", cat("o-", k))),
        status=text("completed"),
        performedDateTime=F.when(kind == "purchase", at),
        performedPeriod=F.when(
            kind == "signup",
            obj(
                start=at,
                end=text(iso(shifted(F.col("ts"), F.lit(1), F.lit(0)))),
            ),
        ),
        category=concept(code=text("surgery"), display=text("Surgery")),
        code=concept(
            text_node=text(cat("Procedure ", k % 15)),
            code=text(cat("P", k % 15)),
            system=text("proc"),
            display=unless(every(k, 4), text(cat("Named procedure ", k % 15))),
        ),
        bodySite=F.when(
            every(k, 2),
            arr(concept(code=text(cat("BS", k % 3)), display=text(cat("Site ", k % 3)))),
        ),
    )


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "Patient": patients,
    "Encounter": encounters,
    "Observation": observations,
    "Condition": conditions,
    "Medication": medications,
    "MedicationRequest": requests,
    "MedicationAdministration": administrations,
    "MedicationDispense": dispenses,
    "MedicationStatement": statements,
    "Procedure": procedures,
}


# Types with order or medication links that may be left dangling.
LINKED = ("MedicationRequest", "MedicationAdministration")


def source_lines(
    spark: SparkSession, sf_dir: str, resource_type: str, dangling: bool = True
) -> DataFrame:
    """``resource_type, source_file, value``: the source text of one type."""
    options = {} if dangling or resource_type not in LINKED else {"dangling": False}
    return BUILDERS[resource_type](spark, sf_dir, **options)


def all_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, id, source_file, value`` of all resources but notes, and but stays and
    procedures that lack a required reference; order and medication links resolve."""
    parts = [
        source_lines(spark, sf_dir, kind, dangling=False).select(
            F.lit(kind).alias("kind"),
            F.get_json_object("value", "$.id").alias("id"),
            "source_file",
            "value",
        )
        for kind in BUILDERS
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    kind, value = F.col("kind"), F.col("value")
    subject = value.rlike(r'"subject":\{[^}]*"reference":"[^"]*[^"/]"')
    lacking = (kind.isin("Encounter", "Procedure") & ~subject) | ((kind == "Procedure") & ~value.contains("Encounter/"))
    notes = F.col("source_file").startswith("MimicObservationNotes")
    return whole.filter(~notes & ~lacking)


def bronze_of(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    """Bronze rows of one type straight from the tables (nothing written)."""
    lines = source_lines(spark, sf_dir, resource_type)
    return bronze_rows(lines, DATASET_NAME, DATASET_VERSION, INGESTED_AT)
