"""Relationship audit, privacy audit, quality gate and marts."""

import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardlake.operators import marts, privacy, quality, relationships
from wardlake.plans.registry import GOLD, GOLD_TABLES, SILVER, SILVER_TABLES


@pytest.fixture(scope="session")
def silver_of(spark):
    def build(**rows):
        return {
            name: spark.createDataFrame(
                [tuple(r.get(c) for c in t.columns) for r in rows.get(name, [])], t.schema
            )
            for name, t in SILVER.items()
        }

    return build


@pytest.fixture(scope="session")
def gold_of(spark):
    def build(**rows):
        return {
            name: spark.createDataFrame(
                [tuple(r.get(c) for c in t.columns) for r in rows.get(name, [])], t.schema
            )
            for name, t in GOLD.items()
        }

    return build


@pytest.fixture(scope="session")
def linked(silver_of):
    return silver_of(
        patient=[{"patient_id": "p1"}],
        encounter=[{"encounter_id": "e1", "patient_id": "p1"}],
        medication=[{"medication_id": "m1"}],
        medication_request=[
            {"medication_request_id": "r1", "patient_id": "p1", "medication_id": "mx"},
            {"medication_request_id": "r2", "patient_id": "p1"},
        ],
        medication_administration=[
            {"patient_id": "p1", "medication_request_id": "rx"},
            {"patient_id": "px", "encounter_id": "e1"},
            {"patient_id": "px", "encounter_id": "e1"},
        ],
        medication_ingredient=[{"medication_id": None, "ingredient_medication_id": "m1"}],
    )


def test_registry_has_all_metrics(spark):
    missing = [m for t in SILVER_TABLES for m in relationships.missing_rules(t)]
    assert len(missing) == 17
    assert len(relationships.ORPHAN_METRICS) == 19
    assert len(set(missing + list(relationships.ORPHAN_METRICS))) == 36


def test_relationship_metrics(spark, linked):
    metrics = relationships.relationship_metrics(spark, linked)
    found = {r.metric: r.value for r in metrics.collect()}
    assert len(found) == 11 + 17 + 19
    expected = {
        "patient_rows": 1,
        "procedure_rows": 0,
        "medication_request_missing_medication_concept": 1,
        "medication_administration_missing_request_id": 2,
        "medication_administration_missing_encounter_id": 1,
        "medication_request_orphan_medication_id": 1,
        "medication_administration_orphan_request_id": 1,
        "medication_administration_orphan_patient_id": 2,
        "medication_ingredient_orphan_medication_id": 0,
        "medication_ingredient_orphan_ingredient_medication_id": 0,
    }
    assert {k: found[k] for k in expected} == expected
    verdict = relationships.relationship_verdict(metrics).first()
    assert (verdict.orphan_rows, verdict.orphan_metrics, verdict.passed) == (4, 3, False)
    wide = relationships.relationship_wide(metrics).first().asDict()
    assert wide == found
    warned = {r.metric for r in relationships.relationship_warnings(metrics).collect()}
    assert warned == {
        "medication_administration_missing_request_id",
        "medication_administration_missing_encounter_id",
    }


def test_audit_needs_all_tables(spark, linked):
    fewer = {k: v for k, v in linked.items() if k not in ("patient", "procedure")}
    with pytest.raises(relationships.RelationshipAuditError, match="patient, procedure"):
        relationships.relationship_metrics(spark, fewer)


def test_rule_table():
    rules = privacy.column_rules()
    assert len(rules) == 61 + 7 * 11
    assert len({(t, c) for t, c, *_ in rules}) == len(rules)
    for table, column, kind, rationale, _ in rules:
        assert column in SILVER[table].columns
        assert kind and rationale.endswith(".")


TEXT = (
    "Mail a.b@example.org or z@example.org, call 555-123-4567 or (555) 123-4567, "
    "ssn 123-45-6789, host 10.0.0.255, see https://example.org/x?y=1 now"
)


def test_pattern_matches(spark):
    frame = spark.createDataFrame([(TEXT,), ("Patient_10002428",), (None,)], "v string")
    found = frame.select(
        *[privacy.pattern_matches(F.col("v"), n).alias(n) for n in privacy.PATTERNS]
    ).collect()
    assert found[0].email == ["a.b@example.org", "z@example.org"]
    assert found[0].ssn == ["123-45-6789"]
    assert found[0].ipv4 == ["10.0.0.255"]
    assert found[0].url == ["https://example.org/x?y=1"]
    assert found[0].phone == ["555) 123-4567", "555-123-4567"]
    assert all(v == [] for v in found[1])
    assert all(v is None for v in found[2])


def test_patterns_treat_unicode_digits_as_digits(spark):
    frame = spark.createDataFrame([("١٢٣-٤٥-٦٧٨٩",), ("é123-45-6789",)], "v string")
    found = [r[0] for r in frame.select(privacy.has_pattern(F.col("v"), "ssn")).collect()]
    assert found == [True, False]


def test_pattern_findings(silver_of):
    values = [f"{i:03d}-12-3456" for i in range(9)] + ["clean", None, "001-12-3456 again"]
    tables = silver_of(observation=[{"value": v, "display": "x"} for v in values])
    rows = privacy.pattern_findings(tables).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.table_name, row.column_name, row.pattern_name) == ("observation", "value", "ssn")
    assert row.match_count == 10
    assert row.sample_matches == [f"{i:03d}-12-3456" for i in range(5)]
    counts = privacy.pattern_counts(tables)
    assert privacy.privacy_verdict(counts).first()["status"] == "needs_review"
    again = privacy.findings_where_counted(tables, counts).collect()
    assert [tuple(r) for r in again] == [tuple(row)]
    clean = privacy.pattern_counts(silver_of())
    assert clean.count() == 17 * 5
    assert privacy.privacy_verdict(clean).first()["status"] == "passed"
    assert privacy.findings_where_counted(silver_of(), clean) is None


def test_samples_in_the_order_rows_are_stored(spark, silver_of, folder):
    """Against a reader that goes through the stored rows one by one."""
    rng = random.Random(5)
    numbers = [f"{rng.randrange(1000):03d}-12-{rng.randrange(40):04d}" for _ in range(3000)]
    # A third of the rows repeat one match, and a row may hold several.
    values = [
        "900-12-3456" if i % 3 == 0 and i > 4 else f"{n} and {numbers[i - 1]}, {n}"
        for i, n in enumerate(numbers)
    ]
    tables = silver_of(
        observation=[{"value": v, "display": "x@y.org" if i == 7 else None} for i, v in enumerate(values)]
    )
    path = f"{folder}/observation"
    tables["observation"].repartition(3).sortWithinPartitions("value").write.parquet(path)
    stored = spark.read.parquet(path)
    tables["observation"] = stored
    files = sorted(stored.inputFiles())
    expected = []
    for file in files:
        for value in pq.read_table(file.removeprefix("file://"), columns=["value"])["value"].to_pylist():
            for match in sorted(set(re.findall(r"\b\d{3}-\d{2}-\d{4}\b", value))):
                if match not in expected:
                    expected.append(match)
    assert len(files) == 3 and len(expected) > 1000
    for size in (1, 5, 300):
        rows = privacy.pattern_findings(tables, size, order="stored").collect()
        found = {(r.column_name, r.pattern_name): r.sample_matches for r in rows}
        assert found == {("value", "ssn"): expected[:size], ("display", "email"): ["x@y.org"]}
    counts = privacy.pattern_counts(tables)
    again = privacy.findings_where_counted(tables, counts, 300, order="stored").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_samples_of_rows_that_are_not_stored_come_in_their_order(silver_of):
    values = ["300-12-3456 200-12-3456", None, "100-12-3456", "200-12-3456"]
    tables = silver_of(observation=[{"value": v} for v in values])
    row = privacy.pattern_findings(tables, 2, order="stored").first()
    assert row.sample_matches == ["200-12-3456", "300-12-3456"]
    assert privacy.encountered_samples(silver_of()).count() == 0


def test_samples_in_the_order_of_a_column(silver_of):
    rows = [("b", "300-12-3456"), ("c", "100-12-3456 300-12-3456"), ("a", "500-12-3456"), ("d", None)]
    tables = silver_of(
        observation=[{"bronze_resource_id": i, "value": v} for i, v in rows]
    )
    row = privacy.pattern_findings(tables, 3, order=["bronze_resource_id"]).first()
    assert row.sample_matches == ["500-12-3456", "300-12-3456", "100-12-3456"]


def test_column_findings(spark, linked):
    some = {"patient": linked["patient"].drop("race"), "encounter": linked["encounter"]}
    rows = {
        (r.table_name, r.column_name): r
        for r in privacy.column_findings(spark, some, with_population=True).collect()
    }
    assert len(rows) == 138
    assert not rows["patient", "race"].present
    assert rows["patient", "patient_id"].populated_rows == 1
    assert not rows["procedure", "procedure_id"].present
    by_schema = privacy.column_findings(spark, some)
    assert {(r.table_name, r.column_name) for r in by_schema.filter("present").collect()} == {
        k for k, r in rows.items() if r.present
    }
    kinds = {r.classification: r.column_count for r in privacy.classification_counts(by_schema).collect()}
    assert kinds["lineage_metadata"] == 14
    with pytest.raises(ValueError, match="No Silver tables"):
        privacy.column_findings(spark, {})


def checks_of(frame):
    return {r["name"]: r for r in frame.collect()}


def test_required_ids(linked):
    rows = checks_of(quality.required_id_checks(linked))
    assert len(rows) == 10
    assert rows["medication_request_required_ids"].status == "pass"
    assert rows["medication_administration_required_ids"].observed == "3"
    assert rows["procedure_required_ids"].expected == (
        "procedure_id, patient_id, and encounter_id present"
    )


def test_relationship_checks(spark, linked):
    metrics = relationships.relationship_metrics(spark, linked)
    rows = checks_of(quality.relationship_checks(metrics))
    assert rows["silver_relationship_orphans"].status == "fail"
    assert rows["silver_relationship_orphans"].observed == "4"
    assert {r.status for n, r in rows.items() if "missing" in n} == {"warn"}


def test_guard_turns_errors_into_failed_checks(spark):
    def broken():
        raise KeyError("procedure")

    row = quality.guarded(spark, "group", "gold", broken).first()
    assert (row.name, row.status, row.observed) == ("group", "fail", "KeyError")
    assert row.expected == "check completes successfully"


def test_gold_metric_checks(gold_of):
    daily = {"measurement_count": 1, "min_value": 1.0, "avg_value": 2.0, "max_value": 3.0}
    tables = gold_of(
        encounter_summary=[{"encounter_key": k} for k in ("a", "a", "b", None, None)],
        vitals_daily=[daily, {**daily, "measurement_count": 0}],
        labs_daily=[daily, {**daily, "avg_value": 3.1}, {**daily, "avg_value": 3.0000000001}],
    )
    found = {n: (r.status, r.observed) for n, r in checks_of(quality.gold_metric_checks(tables)).items()}
    assert found == {
        "gold_encounter_unique_keys": ("fail", "3"),
        "gold_vitals_positive_counts": ("fail", "1"),
        "gold_vitals_value_ordering": ("pass", "0"),
        "gold_labs_positive_counts": ("pass", "0"),
        "gold_labs_value_ordering": ("fail", "1"),
    }


@pytest.mark.parametrize(
    ("statuses", "expected"),
    [
        (["pass", "warn", "fail"], ("failed", False, 3, 1, 1)),
        (["pass", "warn"], ("warning", True, 2, 0, 1)),
        (["pass"], ("passed", True, 1, 0, 0)),
    ],
)
def test_report_status(spark, statuses, expected):
    rows = [("n", "silver", s, "0", "0", "") for s in statuses]
    checks = spark.createDataFrame(rows, quality.CHECK_SCHEMA)
    assert tuple(quality.quality_report(checks).first()) == expected
    assert quality.layer_summary(checks).count() == len(set(statuses))


def test_expected_counts(spark):
    counts = quality.table_rows({"a": ("silver", spark.range(3)), "b": ("gold", spark.range(2))})
    rows = checks_of(quality.expected_count_checks(spark, counts, {"a": 3, "b": 5, "c": 1}))
    assert {n: r.status for n, r in rows.items()} == {"a": "pass", "b": "fail", "c": "fail"}
    assert rows["c"].observed == "0"


def test_bins_keep_their_order(gold_of):
    tables = gold_of(
        encounter_summary=[
            {"length_of_stay_hours": h, "observation_count": n}
            for h, n in ((None, 0), (-5, 99), (23, 100), (24, 999), (72, 1000), (167, 4999), (168, 5000))
        ]
    )
    assert [tuple(r) for r in marts.length_of_stay_bins(tables).collect()] == [
        ("< 1 day", 2),
        ("1-3 days", 1),
        ("3-7 days", 2),
        ("7+ days", 1),
        ("unknown", 1),
    ]
    assert [tuple(r) for r in marts.observation_load_bins(tables).collect()] == [
        ("0", 1),
        ("1-99", 1),
        ("100-999", 2),
        ("1k-5k", 2),
        ("5k+", 1),
    ]


def test_top_lists_break_ties_by_label(gold_of):
    rows = [{"discharge_disposition": f"d{i:02d}"} for i in range(20)] + [{}, {}]
    found = marts.discharge_dispositions(gold_of(encounter_summary=rows)).collect()
    assert [r.label for r in found] == ["unknown", *[f"d{i:02d}" for i in range(11)]]


def test_trend_index(gold_of):
    def day(name, index, mean, count=1):
        return {
            "measurement_name": name,
            "event_day_index": index,
            "avg_value": mean,
            "measurement_count": count,
        }

    tables = gold_of(
        vitals_daily=[
            day("hr", -1, 500.0),
            day("hr", 1, 80.0, 2),
            day("hr", 1, 90.0),
            day("hr", 3, 102.0),
            day("hr", 8, 999.0),
            day("zero", 0, 0.0),
            day("zero", 1, 5.0),
        ]
    )
    assert [tuple(r) for r in marts.vitals_trend(tables).collect()] == [
        ("hr", 1, 85.0, 100.0, 3),
        ("hr", 3, 102.0, 120.0, 1),
        ("zero", 0, 0.0, None, 1),
        ("zero", 1, 5.0, None, 1),
    ]


def test_headline_and_validation(spark, silver_of, gold_of, linked):
    counts = marts.table_counts(spark.range(9), linked, gold_of())
    assert counts.count() == 1 + len(SILVER_TABLES) + len(GOLD_TABLES)
    checks = spark.createDataFrame([("n", "l", "pass", "", "", "")], quality.CHECK_SCHEMA)
    top = marts.headline_metrics(counts, quality.quality_report(checks))
    row = top.first()
    assert (row.source_resources, row.patients, row.medication_events) == (9, 1, 5)
    assert (row.quality_status, row.failed_checks, row.warning_checks) == ("passed", 0, 0)
    metrics = relationships.relationship_metrics(spark, linked)
    found = {
        r.assertion: r.passed
        for r in marts.mart_validation(
            {"some": spark.range(1), "none": spark.range(0)}, top, metrics, {"patients": 1, "procedures": 7}
        ).collect()
    }
    assert found == {
        "some is not empty": True,
        "none is not empty": False,
        "no failed checks": True,
        "references resolve": False,
        "patients as expected": True,
        "procedures as expected": False,
    }
