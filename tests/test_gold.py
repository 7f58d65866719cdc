"""Gold values against hand-worked numbers and a brute-force pandas check."""

import hashlib
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from wardlake.operators import gold
from wardlake.operators.lookups import left_lookup
from wardlake.plans.registry import GOLD_TABLES, SILVER


def key(namespace, value):
    return None if value is None else hashlib.md5(f"{namespace}:{value}".encode()).hexdigest()


@pytest.fixture(scope="session")
def silver_of(spark):
    """Silver tables from partial rows; unnamed columns are null."""

    def build(**rows):
        tables = {}
        for name, table in SILVER.items():
            full = [
                tuple(row.get(c) for c in table.columns) for row in rows.get(name, [])
            ]
            tables[name] = spark.createDataFrame(full, table.schema)
        return tables

    return build


@pytest.fixture(scope="session")
def small(silver_of):
    who = {"patient_id": "p1", "encounter_id": "e1"}
    drug = {"medication_code": "M", "medication_display": "Drug"}
    return silver_of(
        encounter=[
            {
                **who,
                "status": "finished",
                "class_code": "EMER",
                "class_display": "emergency",
                "start_datetime": "2180-01-01T22:00:00-05:00",
                "end_datetime": "2180-01-02T00:00:00-05:00",
                "discharge_disposition": "HOME",
            }
        ],
        observation=[
            {**who, "display": "Heart Rate", "value": "80", "unit": "bpm",
             "category_code": "vs", "effective_datetime": "2180-01-01T23:00:00-05:00"},
            {**who, "display": "Heart Rate", "value": "90", "unit": "bpm",
             "category_code": "vs", "effective_datetime": "2180-01-01T23:30:00-05:00"},
            {**who, "display": "Glucose", "value": "100.5", "unit": "mg/dL",
             "category_code": "Labs", "effective_datetime": "2180-01-02T01:00:00-05:00"},
            {**who, "display": "Glucose", "value": "high", "category_code": "Labs",
             "effective_datetime": "2180-01-02T01:00:00-05:00"},
        ],
        condition=[{**who, "code": "C", "display": "Cond"}, {**who, "code": "C", "display": "Cond"}],
        medication_request=[
            {**who, **drug, "medication_request_id": "r1", "status": "completed",
             "intent": "order", "authored_datetime": "2180-01-01T22:10:00-05:00"}
        ],
        medication_administration=[
            {**who, **drug, "medication_request_id": "r1", "source_system": "hospital",
             "effective_start_datetime": "2180-01-01T23:10:00-05:00"},
            {**who, **drug, "medication_request_id": "r1", "source_system": "hospital",
             "effective_start_datetime": "2180-01-01T22:40:00-05:00"},
        ],
        medication_dispense=[
            {**who, **drug, "medication_request_id": "r1", "source_system": "inpatient",
             "when_handed_over_datetime": "2180-01-01T22:20:00-05:00"}
        ],
        medication_statement=[{"patient_id": "p1", "source_system": "ed"}],
        procedure=[{**who, "procedure_code": "P", "procedure_display": "Proc",
                    "source_system": "icu"}],
    )


def test_encounter_summary(small):
    row = gold.build_gold("encounter_summary", small).first()
    assert row.encounter_key == key("encounter", "e1")
    assert row.patient_key == key("patient", "p1")
    assert (row.encounter_start_year, row.encounter_start_month) == (2180, 1)
    assert row.length_of_stay_hours == 2
    assert row.observation_count == 4
    assert (row.condition_count, row.distinct_condition_count) == (2, 1)
    assert row.medication_administration_count == 2
    assert row.medication_statement_count == 0
    assert row.distinct_medication_count == 1
    assert (row.procedure_count, row.distinct_procedure_count) == (1, 1)


def test_daily_tables(small):
    vitals = gold.build_gold("vitals_daily", small).collect()
    assert [tuple(r)[2:] for r in vitals] == [(0, "Heart Rate", "bpm", 2, 80.0, 85.0, 90.0)]
    labs = gold.build_gold("labs_daily", small).collect()
    assert [tuple(r)[2:] for r in labs] == [(1, "Glucose", "mg/dL", 1, 100.5, 100.5, 100.5)]


def test_condition_and_procedure_summary(small):
    assert tuple(gold.build_gold("condition_summary", small).first()) == (
        "C", "Cond", "EMER", "emergency", 1, 1, 2,
    )
    assert tuple(gold.build_gold("procedure_summary", small).first()) == (
        "P", "Proc", "icu", "EMER", "emergency", 1, 1, 1, 0,
    )


def test_medication_activity(small):
    rows = {r.activity_type: r for r in gold.build_gold("medication_activity", small).collect()}
    assert set(rows) == {"request", "administration", "dispense", "statement"}
    assert rows["request"].source_system == "order"
    assert rows["administration"].event_count == 2
    nothing = rows["statement"]
    assert (nothing.medication_code, nothing.medication_display) == ("unknown", "unknown")
    assert (nothing.with_encounter_context_count, nothing.without_encounter_context_count) == (0, 1)
    assert nothing.encounter_class is None


@pytest.mark.parametrize(
    ("given", "handed", "path"),
    [
        (1, 1, "administered_and_dispensed"),
        (2, 0, "administered"),
        (0, 1, "dispensed"),
        (0, 0, "no_linked_event"),
    ],
)
def test_fulfillment_path(silver_of, given, handed, path):
    tables = silver_of(
        medication_request=[{"medication_request_id": "r1", "patient_id": "p"}],
        medication_administration=[{"medication_request_id": "r1"}] * given
        + [{"medication_request_id": None}],
        medication_dispense=[{"medication_request_id": "r1"}] * handed,
    )
    row = gold.build_gold("medication_order_fulfillment", tables).first()
    assert row.fulfillment_path == path
    assert (row.administration_count, row.dispense_count) == (given, handed)
    assert row.encounter_key is None


def test_first_times_are_the_smallest_texts(small):
    row = gold.build_gold("medication_order_fulfillment", small).first()
    assert row.first_administration_datetime == "2180-01-01T22:40:00-05:00"
    assert row.first_dispense_datetime == "2180-01-01T22:20:00-05:00"
    assert row.authored_year == 2180


def test_gold_surface(small):
    built = gold.build_all_gold(small)
    assert [r.table_name for r in gold.gold_surface(built).collect()] == [
        t.name for t in GOLD_TABLES
    ]
    for table in GOLD_TABLES:
        assert built[table.name].dtypes == [
            (f.name, f.dataType.simpleString()) for f in table.schema.fields
        ]
    leaking = {**built, "labs_daily": small["observation"]}
    rows = {r.table_name: r.forbidden_columns for r in gold.gold_surface(leaking).collect()}
    assert rows["labs_daily"] == "bronze_resource_id, encounter_id, observation_id, patient_id"


def hot_tables(silver_of, seed=7):
    """A third of all facts on one patient and encounter, a third without one."""
    draw = random.Random(seed)
    encounters = [
        {"encounter_id": f"e{i}", "patient_id": f"p{i % 7}", "class_code": f"c{i % 3}",
         "start_datetime": None if i % 4 == 0 else f"2180-01-{1 + i:02d}T20:00:00"}
        for i in range(12)
    ]
    encounters.append(dict(encounters[1], class_code="again"))  # a repeated id

    def owner(i):
        if i % 3 == 0:
            return {"patient_id": "p0", "encounter_id": "e1"}
        if i % 3 == 1:
            return {"patient_id": f"p{draw.randrange(9)}", "encounter_id": None}
        return {
            "patient_id": f"p{draw.randrange(9)}",
            "encounter_id": f"e{draw.randrange(15)}",
        }

    conditions = [
        {**owner(i), "code": draw.choice(["a", "b", None]), "display": draw.choice(["x", "y"])}
        for i in range(900)
    ]
    observations = [
        {**owner(i), "display": draw.choice(gold.VITAL_DISPLAYS[:2]), "unit": draw.choice(["u", None]),
         "value": str(draw.randrange(50)), "category_code": "vs",
         "effective_datetime": f"2180-01-{draw.randrange(1, 28):02d}T0{draw.randrange(9)}:00:00"}
        for i in range(900)
    ]
    return encounters, conditions, observations, silver_of(
        encounter=encounters, condition=conditions, observation=observations
    )


def test_condition_summary_with_hot_and_null_keys(silver_of):
    encounters, conditions, _, tables = hot_tables(silver_of)
    by_id = defaultdict(list)
    for e in encounters:
        by_id[e["encounter_id"]].append(e)
    rows, people, stays = Counter(), defaultdict(set), defaultdict(set)
    for c in conditions:
        for e in by_id.get(c["encounter_id"]) or [{}]:
            group = (c["code"], c["display"], e.get("class_code"), None)
            rows[group] += 1
            people[group].add(c["patient_id"])
            if c["encounter_id"]:
                stays[group].add(c["encounter_id"])
    expected = {
        (*g, len(people[g]), len(stays[g]), n) for g, n in rows.items()
    }
    found = gold.build_gold("condition_summary", tables).collect()
    assert {tuple(r) for r in found} == expected
    assert len(found) == len(expected)


def test_daily_with_hot_and_null_keys(silver_of):
    encounters, _, observations, tables = hot_tables(silver_of)
    start = date(2180, 1, 1)
    day_of = lambda text: date.fromisoformat(text[:10])
    by_id = defaultdict(list)
    for e in encounters:
        by_id[e["encounter_id"]].append(e["start_datetime"])
    firsts = {}
    for o in observations:
        day = day_of(o["effective_datetime"])
        firsts[o["patient_id"]] = min(firsts.get(o["patient_id"], day), day)
    values = defaultdict(list)
    for o in observations:
        for begin in by_id.get(o["encounter_id"]) or [None]:
            zero = day_of(begin) if begin else firsts[o["patient_id"]]
            index = (day_of(o["effective_datetime"]) - zero) // timedelta(days=1)
            group = (
                key("patient", o["patient_id"]),
                key("encounter", o["encounter_id"]),
                index,
                o["display"],
                o["unit"],
            )
            values[group].append(float(o["value"]))
    expected = {
        (*g, len(v), min(v), round(sum(v) / len(v), 9), max(v)) for g, v in values.items()
    }
    found = {
        (*tuple(r)[:7], round(r.avg_value, 9), r.max_value)
        for r in gold.build_gold("vitals_daily", tables).collect()
    }
    assert found == expected
    assert any(g[2] < 0 for g in values) and start


def test_null_keys_are_spread(spark):
    facts = spark.range(2000).selectExpr(
        "cast(id as string) as fact", "if(id % 3 = 0, null, 'k1') as k"
    )
    dimension = spark.createDataFrame([("k1", 1), (None, 2), ("-5", 3)], "k string, v int")
    joined = left_lookup(facts, dimension, "k")
    assert joined.columns == ["fact", "k", "v"]
    rows = joined.collect()
    assert len(rows) == 2000
    assert all((r.v is None) == (r.k is None) for r in rows)
    # The made-up keys are part of the hash key, not a filter after it.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = left_lookup(facts, dimension, "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(_join_key" in plan
