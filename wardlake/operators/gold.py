"""Gold: pseudonymised analytics tables over Silver.

Every table folds its facts to the grain it needs before anything is joined, so
a patient, encounter or order that holds a large part of all rows reaches the
shuffle as a few partial rows. No table is globally sorted; order belongs to the
reader.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions.scalars import (
    hour_boundaries,
    number_or_null,
    stable_key,
    wall_clock,
)
from wardlake.operators.lookups import left_lookup
from wardlake.plans.registry import (
    FORBIDDEN_GOLD_COLUMNS,
    GOLD_TABLES,
    MEDICATION_EVENTS,
    gold_table,
)
from wardlake.sources.tables import as_layout, union_all

Tables = Mapping[str, DataFrame]

# The vital signs and laboratory categories that are reported.
VITAL_DISPLAYS = (
    "Heart Rate",
    "Respiratory Rate",
    "O2 saturation pulseoxymetry",
    "Temperature Fahrenheit",
    "Non Invasive Blood Pressure systolic",
    "Non Invasive Blood Pressure diastolic",
    "Non Invasive Blood Pressure mean",
)
LAB_CATEGORIES = ("laboratory", "Labs")


def concept_key(code: str, display: str) -> Column:
    return F.concat(
        F.coalesce(code, F.lit("")), F.lit("|"), F.coalesce(display, F.lit(""))
    )


def _finish(df: DataFrame, name: str) -> DataFrame:
    return as_layout(df, gold_table(name).schema)


def _encounter_class(silver: Tables) -> DataFrame:
    return silver["encounter"].select(
        "encounter_id",
        F.col("class_code").alias("encounter_class"),
        F.col("class_display").alias("encounter_class_display"),
    )


def encounter_activity(silver: Tables) -> DataFrame:
    """Event and distinct-concept counts per encounter, all sources in one pass.

    The seven event tables form one long stream of (encounter, domain, concept).
    It is folded per concept first and per encounter second; distinct concepts
    are then plain row counts and no distinct aggregate is needed.
    """
    medication = concept_key("medication_code", "medication_display")
    streams = [
        ("observation", "observation", F.lit(None).cast("string")),
        ("condition", "condition", concept_key("code", "display")),
        *[(t.name, "medication", medication) for t in MEDICATION_EVENTS],
        (
            "procedure",
            "procedure",
            concept_key("procedure_code", "procedure_display"),
        ),
    ]
    kinds = {name: number for number, (name, _, _) in enumerate(streams)}
    domains = {"observation": 0, "condition": 1, "medication": 2, "procedure": 3}
    events = union_all(
        [
            silver[name]
            .filter(F.col("encounter_id").isNotNull())
            .select(
                "encounter_id",
                F.lit(kinds[name]).alias("kind"),
                F.lit(domains[domain]).alias("domain"),
                concept.alias("concept"),
            )
            for name, domain, concept in streams
        ]
    )
    per_concept = events.groupBy("encounter_id", "domain", "concept").agg(
        *[
            F.count_if(F.col("kind") == number).alias(f"{kind}_count")
            for kind, number in kinds.items()
        ]
    )
    return per_concept.groupBy("encounter_id").agg(
        *[F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in kinds],
        *[
            F.count_if(F.col("domain") == domains[domain]).alias(
                f"distinct_{domain}_count"
            )
            for domain in ("condition", "medication", "procedure")
        ],
    )


def encounter_summary(silver: Tables) -> DataFrame:
    stays = silver["encounter"].select(
        "encounter_id",
        "patient_id",
        "status",
        "class_code",
        "class_display",
        "discharge_disposition",
        wall_clock(F.col("start_datetime")).alias("start_ts"),
        wall_clock(F.col("end_datetime")).alias("end_ts"),
    )
    activity = encounter_activity(silver)
    counts = [name for name in activity.columns if name != "encounter_id"]
    # One stay per encounter: the key needs no spreading, and the join takes over
    # the exchange of the activity's fold.
    joined = stays.join(activity, "encounter_id", "left")
    return _finish(
        joined.select(
            stable_key("encounter", F.col("encounter_id")).alias("encounter_key"),
            stable_key("patient", F.col("patient_id")).alias("patient_key"),
            F.col("status").alias("encounter_status"),
            F.col("class_code").alias("encounter_class"),
            F.col("class_display").alias("encounter_class_display"),
            F.year("start_ts").alias("encounter_start_year"),
            F.month("start_ts").alias("encounter_start_month"),
            hour_boundaries(F.col("start_ts"), F.col("end_ts")).alias(
                "length_of_stay_hours"
            ),
            *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
            "discharge_disposition",
        ),
        "encounter_summary",
    )


def _per_class(
    facts: DataFrame, silver: Tables, group: list[str], **measures: Column
) -> DataFrame:
    """Patients, encounters and summed measures per group and encounter class.

    Facts are folded per (group, patient, encounter) before the encounter join,
    so the distinct counts only see rows that are already distinct.
    """
    people = ["patient_id", "encounter_id"]
    folded = facts.groupBy(*group, *people).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    classed = left_lookup(folded, _encounter_class(silver), "encounter_id")
    classes = ["encounter_class", "encounter_class_display"]
    return classed.groupBy(*group, *classes).agg(
        F.countDistinct("patient_id").alias("patient_count"),
        F.countDistinct("encounter_id").alias("encounter_count"),
        *[F.sum(name).alias(name) for name in measures],
    )


def condition_summary(silver: Tables) -> DataFrame:
    facts = silver["condition"].select(
        F.col("code").alias("condition_code"),
        F.col("display").alias("condition_display"),
        "patient_id",
        "encounter_id",
    )
    counted = _per_class(
        facts,
        silver,
        ["condition_code", "condition_display"],
        condition_row_count=F.count("*"),
    )
    return _finish(counted, "condition_summary")


def procedure_summary(silver: Tables) -> DataFrame:
    counted = _per_class(
        silver["procedure"],
        silver,
        ["procedure_code", "procedure_display", "source_system"],
        procedure_count=F.count("*"),
        with_body_site_count=F.count("body_site_code"),
    )
    return _finish(counted, "procedure_summary")


def medication_events(silver: Tables) -> DataFrame:
    """The four medication event tables as one stream with an activity tag."""
    streams = []
    for table in MEDICATION_EVENTS:
        activity = table.name.removeprefix("medication_")
        source = F.lit("order") if activity == "request" else F.col("source_system")
        code = F.coalesce("medication_code", F.lit("unknown"))
        streams.append(
            silver[table.name].select(
                "patient_id",
                "encounter_id",
                code.alias("medication_code"),
                F.coalesce("medication_display", code).alias("medication_display"),
                F.lit(activity).alias("activity_type"),
                source.alias("source_system"),
            )
        )
    return union_all(streams)


def medication_activity(silver: Tables) -> DataFrame:
    counted = _per_class(
        medication_events(silver),
        silver,
        ["medication_code", "medication_display", "activity_type", "source_system"],
        event_count=F.count("*"),
        with_encounter_context_count=F.count("encounter_id"),
        without_encounter_context_count=F.count_if(F.col("encounter_id").isNull()),
    )
    return _finish(counted, "medication_activity")


def medication_order_fulfillment(silver: Tables) -> DataFrame:
    """Orders with their linked administrations and dispenses.

    Both event tables are folded together in one aggregate per order. First
    times are the smallest texts, whatever zone they carry.
    """
    none = F.lit(None).cast("string")
    given = silver["medication_administration"].select(
        "medication_request_id",
        F.lit(1).alias("given"),
        F.lit(0).alias("handed"),
        F.col("effective_start_datetime").alias("given_at"),
        none.alias("handed_at"),
    )
    handed = silver["medication_dispense"].select(
        "medication_request_id",
        F.lit(0).alias("given"),
        F.lit(1).alias("handed"),
        none.alias("given_at"),
        F.col("when_handed_over_datetime").alias("handed_at"),
    )
    events = given.unionByName(handed).filter(
        F.col("medication_request_id").isNotNull()
    )
    linked = events.groupBy("medication_request_id").agg(
        F.sum("given").alias("administration_count"),
        F.sum("handed").alias("dispense_count"),
        F.min("given_at").alias("first_administration_datetime"),
        F.min("handed_at").alias("first_dispense_datetime"),
    )
    orders = silver["medication_request"].select(
        "medication_request_id",
        "patient_id",
        "encounter_id",
        "medication_code",
        "medication_display",
        "status",
        "intent",
        "authored_datetime",
    )
    counts = {
        name: F.coalesce(name, F.lit(0))
        for name in ("administration_count", "dispense_count")
    }
    flagged = (
        left_lookup(orders, linked, "medication_request_id")
        .withColumns(counts)
        .withColumns(
            {
                "has_administration": F.col("administration_count") > 0,
                "has_dispense": F.col("dispense_count") > 0,
            }
        )
    )
    given, handed = F.col("has_administration"), F.col("has_dispense")
    path = (
        F.when(given & handed, "administered_and_dispensed")
        .when(given, "administered")
        .when(handed, "dispensed")
        .otherwise("no_linked_event")
    )
    return _finish(
        flagged.select(
            stable_key("medication_request", F.col("medication_request_id")).alias(
                "medication_request_key"
            ),
            stable_key("patient", F.col("patient_id")).alias("patient_key"),
            stable_key("encounter", F.col("encounter_id")).alias("encounter_key"),
            "medication_code",
            "medication_display",
            F.col("status").alias("request_status"),
            F.col("intent").alias("request_intent"),
            F.year(wall_clock(F.col("authored_datetime"))).alias("authored_year"),
            "administration_count",
            "dispense_count",
            "first_administration_datetime",
            "first_dispense_datetime",
            "has_administration",
            "has_dispense",
            path.alias("fulfillment_path"),
        ),
        "medication_order_fulfillment",
    )


#: Name under which a mapping of Silver tables may hold a written measurement fold.
FOLD = "measurement_fold"
_GRAIN = ["patient_id", "encounter_id", "measurement_name", "unit"]


def _is_vital() -> Column:
    return F.col("display").isin(*VITAL_DISPLAYS)


def _is_lab() -> Column:
    return F.col("category_code").isin(*LAB_CATEGORIES)


def _per_date(observation: DataFrame, *kinds: Column) -> DataFrame:
    """Numeric measurements folded per date, by kind where kinds are given."""
    measured = (
        observation.select(
            "patient_id",
            "encounter_id",
            F.col("display").alias("measurement_name"),
            "unit",
            number_or_null(F.col("value")).alias("number"),
            wall_clock(F.col("effective_datetime")).cast("date").alias("event_date"),
            *kinds,
        )
        .filter(F.col("patient_id").isNotNull())
        .filter(F.col("number").isNotNull() & F.col("event_date").isNotNull())
    )
    keys = [name for name in measured.columns if name != "number"]
    return measured.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min("number").alias("low"),
        F.sum("number").alias("total"),
        F.max("number").alias("high"),
    )


def measurement_fold(observation: DataFrame) -> DataFrame:
    """Vitals and labs folded per patient, encounter, name, unit and date, marked with
    the kinds they belong to. Its counts, sums and limits can be merged further, so
    that one scan of the measurements, once written, serves both daily tables."""
    no = F.lit(False)
    vital, lab = F.coalesce(_is_vital(), no), F.coalesce(_is_lab(), no)
    return _per_date(
        observation.filter(vital | lab), vital.alias("is_vital"), lab.alias("is_lab")
    )


def _daily_of(daily: DataFrame, encounter: DataFrame) -> DataFrame:
    """Days of measurements that are folded per date.

    Day distances depend on calendar dates alone. The day counts from the encounter's
    start, or from the patient's first date among these measurements; that date comes
    from a second fold joined back, not from a window over a patient's rows.
    """
    starts = encounter.select(
        "encounter_id",
        wall_clock(F.col("start_datetime")).cast("date").alias("start_date"),
    )
    # From the fold per date: the optimiser prunes it to the columns a date needs.
    firsts = daily.groupBy("patient_id").agg(F.min("event_date").alias("first_date"))
    # Every patient has a first date; the lookup keeps a hot patient splittable.
    placed = left_lookup(
        left_lookup(daily, starts, "encounter_id"), firsts, "patient_id"
    )
    zero = F.coalesce("start_date", "first_date")
    day = F.datediff("event_date", zero).cast("bigint")
    folded = placed.groupBy(*_GRAIN, day.alias("event_day_index")).agg(
        F.sum("n").alias("measurement_count"),
        F.min("low").alias("min_value"),
        (F.sum("total") / F.sum("n")).alias("avg_value"),
        F.max("high").alias("max_value"),
    )
    return folded.select(
        stable_key("patient", F.col("patient_id")).alias("patient_key"),
        stable_key("encounter", F.col("encounter_id")).alias("encounter_key"),
        "event_day_index",
        "measurement_name",
        "unit",
        "measurement_count",
        "min_value",
        "avg_value",
        "max_value",
    )


def observation_daily(silver: Tables, where: Column) -> DataFrame:
    """Numeric measurements per patient, encounter, day, name and unit."""
    daily = _per_date(silver["observation"].filter(where))
    return _daily_of(daily, silver["encounter"])


def _kind_daily(silver: Tables, where: Column, mark: str) -> DataFrame:
    if FOLD not in silver:
        return observation_daily(silver, where)
    kept = silver[FOLD].filter(mark).drop("is_vital", "is_lab")
    return _daily_of(kept, silver["encounter"])


def vitals_daily(silver: Tables) -> DataFrame:
    return _finish(_kind_daily(silver, _is_vital(), "is_vital"), "vitals_daily")


def labs_daily(silver: Tables) -> DataFrame:
    return _finish(_kind_daily(silver, _is_lab(), "is_lab"), "labs_daily")


_BUILDERS: Mapping[str, Callable[[Tables], DataFrame]] = {
    "encounter_summary": encounter_summary,
    "condition_summary": condition_summary,
    "vitals_daily": vitals_daily,
    "labs_daily": labs_daily,
    "medication_activity": medication_activity,
    "medication_order_fulfillment": medication_order_fulfillment,
    "procedure_summary": procedure_summary,
}


def build_gold(name: str, silver: Tables) -> DataFrame:
    """One Gold table by name, from a mapping of Silver tables."""
    gold_table(name)
    return _BUILDERS[name](silver)


def build_all_gold(silver: Tables) -> dict[str, DataFrame]:
    return {table.name: build_gold(table.name, silver) for table in GOLD_TABLES}


def gold_surface(gold: Tables) -> DataFrame:
    """Row count and forbidden columns of every Gold table."""
    rows = []
    for table in GOLD_TABLES:
        df = gold[table.name]
        exposed = sorted(FORBIDDEN_GOLD_COLUMNS.intersection(df.columns))
        rows.append(
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(table.name).alias("table_name"),
                "row_count",
                F.lit(", ".join(exposed)).alias("forbidden_columns"),
            )
        )
    return union_all(rows)
