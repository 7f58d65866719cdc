"""Expected results of the registered queries as SQL over the flat tables.

Layer tables (``s_``, ``g_``, ``b_``) are spelled out in
:mod:`wardlake.harness.oracle_tables` and put in front of each statement.
"""

from __future__ import annotations

from wardlake.harness.oracle_rules import (
    EXPECTED_LINEAGE,
    EXPECTED_LINEAGE_KIND,
    EXPECTED_LINEAGE_TEXT,
    EXPECTED_PATTERNS,
    EXPECTED_RULES,
    EXPECTED_SCOPE,
    EXPECTED_TABLES,
)
from wardlake.harness.oracle_tables import (
    ENCOUNTER_FAMILY,
    EVENT_NUMBER,
    MEDICATION_NAME,
    RESOURCE_TYPES,
    daily,
    instant,
    with_tables,
)
from wardlake.harness.queries import COUNTED_AS, WRONG_COUNTS
from wardlake.plans.registry import GOLD_TABLES, RESOURCE_TABLES, SILVER_TABLES

ORACLES: dict[str, str] = {}


def expect(name: str, sql: str) -> None:
    ORACLES[name] = with_tables(sql)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def whole(expression: str) -> str:
    return f"CAST(coalesce({expression}, 0) AS BIGINT)"


# --- sources --------------------------------------------------------------

expect(
    "src_1_source_files",
    """SELECT resource_family, CAST(row_number() OVER (
  ORDER BY resource_family || '.') AS INTEGER) AS place
FROM (SELECT DISTINCT resource_family FROM b_resources)""",
)
expect(
    "src_2_ndjson_scan",
    "SELECT resource_family, count(*) AS row_count FROM b_resources GROUP BY 1",
)
expect(
    "src_3_rejected_lines",
    f"""
WITH l AS (
  SELECT o_orderkey AS k, {ENCOUNTER_FAMILY} || '.ndjson.gz' AS source_file FROM orders
), n AS (
  SELECT k, source_file,
    row_number() OVER (PARTITION BY source_file ORDER BY k) AS line_number
  FROM l
)
SELECT source_file, line_number,
  CASE WHEN k % 991 = 0 THEN 'not_an_object' ELSE 'malformed_json' END AS reason
FROM n
WHERE k % 983 <> 0 AND (k % 991 = 0 OR k % 997 = 0 OR k % 1009 = 0)
""",
)
expect(
    "src_4_resource_family",
    """SELECT source_file, resource_family AS family, count(*) AS row_count
FROM b_resources GROUP BY 1, 2""",
)
expect(
    "src_5_first_profile_url",
    """SELECT resource_type, profile_url, count(*) AS row_count
FROM b_resources GROUP BY 1, 2""",
)
expect(
    "src_6_canonical_json",
    r"""
WITH d AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'),
    chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS body
  FROM documents
)
SELECT doc_id,
  '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars
  || ',"source":"' || source || '","text":"'
  || array_to_string(list_transform(string_split(body, ''),
       lambda c: CASE WHEN unicode(c) > 127 THEN '\u' || printf('%04x', unicode(c))
                      ELSE c END), '')
  || '"}' AS canonical_json
FROM d
""",
)
expect("src_7_bronze_rows", "SELECT * FROM b_resources")
expect(
    "src_8_bronze_write",
    """SELECT resource_type, count(*) AS row_count,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows
FROM b_resources GROUP BY 1""",
)
expect(
    "src_9_bronze_by_type",
    """SELECT resource_id, source_file, resource_family, profile_url,
  source_dataset_name, source_dataset_version, ingested_at
FROM b_resources WHERE resource_type = 'Encounter'""",
)
expect(
    "src_10_table_scan",
    "SELECT encounter_id, class_code FROM s_encounter WHERE status = 'finished'",
)
expect("src_11_silver_write", "SELECT * FROM s_encounter")
expect("src_12_gold_write", "SELECT * FROM g_procedure_summary")
expect("src_13_managed_table", "SELECT * FROM s_patient")
expect(
    "src_14_three_part_name",
    "SELECT gender, count(*) AS row_count FROM s_patient GROUP BY 1",
)

# --- profiling ------------------------------------------------------------

INVENTORY = """(SELECT resource_family, min(resource_type) AS resource_type,
  count(*) AS row_count FROM b_resources GROUP BY 1)"""

expect(
    "prf_1_resource_inventory",
    """SELECT resource_family, min(resource_type) AS resource_type,
  CASE WHEN count(profile_url) = count(*) THEN min(profile_url) END AS profile_url,
  count(*) AS row_count FROM b_resources GROUP BY 1""",
)
expect(
    "prf_2_inventory_totals",
    f"""SELECT count(*) AS total_files, {whole("sum(row_count)")} AS total_resources
FROM {INVENTORY}""",
)
expect(
    "prf_5_resource_type_summary",
    f"""SELECT resource_type, count(*) AS file_count,
  {whole("sum(row_count)")} AS row_count FROM {INVENTORY} GROUP BY 1""",
)
expect(
    "prf_6_largest_files",
    f"""SELECT resource_family AS source_file, resource_type, row_count
FROM {INVENTORY} ORDER BY row_count DESC, resource_family LIMIT 8""",
)

# Silver table -> (subject object holds a reference, encounter node reference,
# effective time, issued time, authored time, period start), as flat conditions.
COVERAGE = {
    "s_patient": ("false", "false", "false", "false", "false", "false"),
    "s_encounter": (
        "CAST(substr(encounter_id, 3) AS BIGINT) % 31 <> 0 "
        "AND CAST(substr(encounter_id, 3) AS BIGINT) % 37 <> 0",
        "false",
        "false",
        "false",
        "false",
        "start_datetime IS NOT NULL",
    ),
    "s_observation": (
        "patient_id IS NOT NULL",
        "encounter_id IS NOT NULL",
        "effective_datetime IS NOT NULL",
        "issued_datetime IS NOT NULL",
        "false",
        "false",
    ),
    "s_condition": ("true", "encounter_id IS NOT NULL", "false", "false", "false", "false"),
    "s_medication": ("false", "false", "false", "false", "false", "false"),
    "s_medication_request": (
        "true",
        "encounter_id IS NOT NULL",
        "false",
        "false",
        "true",
        "false",
    ),
    "s_medication_administration": (
        "true",
        "false",
        "CAST(split_part(medication_administration_id, '-', 3) AS BIGINT) % 2 = 1",
        "false",
        "false",
        "false",
    ),
    "s_medication_dispense": ("true", "false", "false", "false", "false", "false"),
    "s_medication_statement": ("true", "false", "false", "false", "false", "false"),
    "s_procedure": ("true", "encounter_id IS NOT NULL", "false", "false", "false", "false"),
}
COVERAGE_NAMES = (
    "has_subject_reference",
    "has_encounter_reference",
    "has_effectivedatetime",
    "has_issued",
    "has_authoredon",
    "has_period_start",
)
COVERAGE_SQL = union(
    f"""SELECT resource_family, count(*) AS sampled_rows, count(*) AS has_id,
  count(*) AS has_resourcetype, count(profile_url) AS has_meta_profile, """
    + ", ".join(
        f"count(*) FILTER (WHERE {condition}) AS {name}"
        for name, condition in zip(COVERAGE_NAMES, conditions, strict=True)
    )
    + f" FROM {table} GROUP BY 1"
    for table, conditions in COVERAGE.items()
)
expect("prf_4_field_coverage", COVERAGE_SQL)
expect(
    "prf_7_core_schema_signals",
    f"""SELECT resource_family AS source_file, sampled_rows,
  has_subject_reference AS subject_refs, has_encounter_reference AS encounter_refs,
  has_effectivedatetime + has_issued + has_authoredon + has_period_start
    AS timestamp_fields
FROM ({COVERAGE_SQL})
WHERE resource_family IN ('MimicPatient', 'MimicEncounter', 'MimicEncounterED',
  'MimicEncounterICU', 'MimicObservationChartevents', 'MimicObservationLabevents',
  'MimicObservationVitalSignsED', 'MimicCondition', 'MimicMedicationRequest')""",
)

# Silver table -> top-level source keys, each with the condition it is present.
_C = "CAST(substr({}, 3) AS BIGINT)"
_E, _M, _Q, _K = (
    _C.format(c)
    for c in ("encounter_id", "medication_id", "procedure_id", "patient_id")
)
_LINE = "split_part({}, '-', {})::BIGINT"
_A_LINE = _LINE.format("medication_administration_id", 3)
_P_PART = _LINE.format("medication_dispense_id", 4)
_R = _C.format("medication_request_id")
KEYS = {
    "s_patient": {
        "meta": "true",
        "identifier": f"{_K} % 13 <> 0",
        "name": "true",
        "gender": "gender IS NOT NULL",
        "birthDate": "true",
        "deceasedDateTime": "deceased_datetime IS NOT NULL",
        "extension": "true",
        "maritalStatus": "true",
    },
    "s_encounter": {
        "meta": "true",
        "subject": "true",
        "status": "true",
        "class": "class_code IS NOT NULL",
        "period": f"{_E} % 113 <> 0",
        "serviceType": "true",
        "hospitalization": "true",
    },
    "s_observation": {
        "meta": "true",
        "subject": "true",
        "status": "true",
        "code": "true",
        "encounter": "encounter_id IS NOT NULL",
        "specimen": "specimen_id IS NOT NULL",
        "effectiveDateTime": "effective_datetime IS NOT NULL",
        "issued": "issued_datetime IS NOT NULL",
        "category": "category_code IS NOT NULL",
        "valueQuantity": "value_type = 'quantity'",
        "valueString": "value_type = 'string'",
        "component": "observation_id LIKE 'e-%' AND coalesce(value_type, 'component') "
        "= 'component'",
    },
    "s_condition": {
        "meta": "true",
        "subject": "true",
        "encounter": "encounter_id IS NOT NULL",
        "category": "true",
        "code": "true",
    },
    "s_medication": {
        "meta": "true",
        "code": f"{_M} % 50 <> 0",
        "form": "true",
        "identifier": "identifier_count > 0",
        "ingredient": "ingredient_count > 0",
    },
    "s_medication_request": {
        "meta": "true",
        "subject": "true",
        "encounter": "encounter_id IS NOT NULL",
        "status": "true",
        "intent": "true",
        "authoredOn": "true",
        "medicationReference": "medication_id IS NOT NULL",
        "medicationCodeableConcept": f"{_R} % 4 = 0 OR ({_R} % 2 = 1 AND {_R} % 21 <> 0)",
        "dosageInstruction": "dosage_instruction_count > 0",
        "dispenseRequest": "validity_start_datetime IS NOT NULL",
    },
    "s_medication_administration": {
        "meta": "true",
        "subject": "true",
        "context": "has_encounter_context",
        "request": "has_request_reference",
        "status": "true",
        "effectiveDateTime": f"{_A_LINE} % 2 = 1",
        "performedDateTime": f"{_A_LINE} = 6",
        "effectivePeriod": f"{_A_LINE} = 2",
        "performedPeriod": f"{_A_LINE} = 4",
        "category": "true",
        "medicationCodeableConcept": "medication_code IS NOT NULL",
        "dosage": "true",
    },
    "s_medication_dispense": {
        "meta": "true",
        "subject": "true",
        "context": "encounter_id IS NOT NULL",
        "status": "true",
        "whenHandedOver": "true",
        "medicationCodeableConcept": "true",
        "authorizingPrescription": f"{_P_PART} % 7 <> 0",
        "dosageInstruction": "true",
    },
    "s_medication_statement": {
        "meta": "profile_url IS NOT NULL",
        "subject": "true",
        "context": "encounter_id IS NOT NULL",
        "status": "true",
        "dateAsserted": "true",
        "medicationCodeableConcept": "true",
    },
    "s_procedure": {
        "meta": "true",
        "subject": "true",
        "encounter": "encounter_id IS NOT NULL",
        "status": "true",
        "performedDateTime": "performed_end_datetime IS NULL",
        "performedPeriod": "performed_end_datetime IS NOT NULL",
        "category": "true",
        "code": "true",
        "bodySite": "body_site_code IS NOT NULL",
    },
}
expect(
    "prf_3_top_level_keys",
    "SELECT DISTINCT resource_family, key FROM ("
    + union(
        f"SELECT resource_family, unnest(list_filter([{entries}], lambda x: x <> '')) "
        f"AS key FROM {table}"
        for table, keys in KEYS.items()
        for entries in [
            ", ".join(
                f"CASE WHEN {condition} THEN '{key}' ELSE '' END"
                for key, condition in {
                    "resourceType": "true",
                    "id": "true",
                    **keys,
                }.items()
            )
        ]
    )
    + ")",
)

# --- Bronze checks --------------------------------------------------------

expect(
    "brz_1_manifest",
    """SELECT 'star-schema-clinic' AS dataset_name, '1.0' AS dataset_version,
  'fhir_resources' AS table_name, CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows,
  resource_family, count(*) AS expected_rows
FROM b_resources GROUP BY resource_family""",
)
expect(
    "brz_2_rows_per_file",
    "SELECT source_file, count(*) AS row_count FROM b_resources GROUP BY 1",
)
expect(
    "brz_3_bronze_validation",
    """SELECT CAST(0 AS BIGINT) AS differing_files, count(*) AS actual_rows,
  count(*) AS manifest_rows FROM b_resources""",
)

expect(
    "brz_3_empty_file",
    """SELECT true AS strict, CAST(1 AS BIGINT) AS differing_files,
  'MimicEmpty.ndjson.gz' AS source_file
UNION ALL SELECT false, 0, NULL""",
)

# --- field extraction -----------------------------------------------------

for _key, _columns, _table in (
    ("ext_1_scalar_text", "encounter_id, status", "s_encounter"),
    (
        "ext_2_reference_tail",
        "medication_request_id, medication_id",
        "s_medication_request",
    ),
    ("ext_3_reference_node", "encounter_id, patient_id", "s_encounter"),
    ("ext_5_first_identifier", "patient_id, source_patient_identifier", "s_patient"),
    ("ext_6_first_family_name", "patient_id, synthetic_patient_name", "s_patient"),
    ("ext_7_first_coding", "patient_id, marital_status_code", "s_patient"),
    ("ext_8_first_coding_in_list", "observation_id, category_code", "s_observation"),
    (
        "ext_9_coding_fields",
        "observation_id, code, code_system, display",
        "s_observation",
    ),
    (
        "ext_10_concept_text",
        "medication_dispense_id, medication_text",
        "s_medication_dispense",
    ),
    (
        "ext_11_concept_fields",
        "procedure_id, procedure_code, procedure_code_system, procedure_display",
        "s_procedure",
    ),
    (
        "ext_12_coding_without_fallback",
        "condition_id, code, code_system, display",
        "s_condition",
    ),
    ("ext_14_extension_text", "patient_id, race, ethnicity, birth_sex", "s_patient"),
    ("ext_16_period", "encounter_id, start_datetime, end_datetime", "s_encounter"),
    (
        "ext_17_effective_window",
        "medication_administration_id, effective_start_datetime, "
        "effective_end_datetime",
        "s_medication_administration",
    ),
    (
        "ext_18_dosage_dose",
        "medication_request_id, dose_value, dose_unit",
        "s_medication_request",
    ),
    (
        "ext_19_dosage_summary",
        "medication_request_id, route_code, route_display, dose_value, dose_unit, "
        "frequency, period, period_unit",
        "s_medication_request",
    ),
    (
        "ext_20_administration_dosage",
        "medication_administration_id, dose_value, dose_unit, method_code, "
        "method_display",
        "s_medication_administration",
    ),
    (
        "ext_21_list_length",
        "medication_id, identifier_count, ingredient_count",
        "s_medication",
    ),
    (
        "ext_23_observation_value",
        "observation_id, value_type, value, unit",
        "s_observation",
    ),
):
    expect(_key, f"SELECT {_columns} FROM {_table}")
expect(
    "ext_4_reference_list",
    """SELECT medication_dispense_id, coalesce(medication_request_id, '') AS request_ids
FROM s_medication_dispense""",
)
expect(
    "ext_13_extension_by_url",
    """SELECT 'c-' || c_custkey AS patient_id, c_custkey % 31 <> 0 AS has_race,
  c_custkey % 31 <> 0 AND c_custkey % 29 <> 0 AS has_birth_sex FROM customer""",
)
expect(
    "ext_15_quantity",
    """SELECT observation_id, CASE WHEN value_type = 'quantity' THEN value END AS value,
  CASE WHEN value_type = 'quantity' THEN unit END AS unit FROM s_observation""",
)
expect(
    "ext_22_identifier_by_system",
    f"""SELECT 'm-' || p_partkey AS medication_id, {MEDICATION_NAME} AS medication_name
FROM part""",
)
expect(
    "ext_24_source_system",
    union(
        f"""SELECT '{RESOURCE_TYPES[table]}' AS resource_type, resource_family,
  source_system, count(*) AS row_count FROM {table} GROUP BY 2, 3"""
        for table in (
            "s_medication_administration",
            "s_medication_dispense",
            "s_procedure",
        )
    ),
)
expect(
    "num_1_number_text",
    f"""SELECT observation_id, value FROM s_observation
WHERE value_type = 'quantity' AND observation_id NOT LIKE 'e-%'
UNION ALL
SELECT 'e-' || event_id, {EVENT_NUMBER} FROM events
WHERE event_type IN ('error', 'click') AND event_id % 8 IN (0, 1, 2, 3, 7)""",
)

# --- Silver ---------------------------------------------------------------

for _number, _silver in enumerate(SILVER_TABLES, start=1):
    expect(f"slv_{_number}_{_silver.name}", f"SELECT * FROM s_{_silver.name}")
expect(
    "slv_12_lineage",
    """SELECT source_file, resource_family, profile_url, source_dataset_name,
  source_dataset_version, ingested_at AS bronze_ingested_at, count(*) AS row_count
FROM b_resources GROUP BY ALL""",
)


def row_counts(layer: str, names) -> str:
    return union(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {layer}_{name}"
        for name in names
    )


SILVER_NAMES = [table.name for table in SILVER_TABLES]
GOLD_NAMES = [table.name for table in GOLD_TABLES]
expect("slv_13_build_all", row_counts("s", SILVER_NAMES))

PARITY = union(
    f"""SELECT '{t.name}' AS table_name, '{t.resource_type}' AS resource_type,
  count(*) AS expected_rows, count(*) AS actual_rows FROM s_{t.name}"""
    for t in RESOURCE_TABLES
)
expect("slc_1_row_parity", PARITY)


def unresolved(source: str, column: str, target: str, keep_null: bool = False) -> str:
    null_rule = "OR s.{0} IS NULL".format(column) if keep_null else ""
    return f"""SELECT count(*) AS unresolved_rows FROM {source} s
WHERE (s.{column} IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM {target} t WHERE t.{column} = s.{column})) {null_rule}"""


expect(
    "slc_2_ingredient_parents",
    unresolved("s_medication_ingredient", "medication_id", "s_medication", True),
)
expect(
    "slc_3_request_medications",
    unresolved("s_medication_request", "medication_id", "s_medication"),
)
expect(
    "slc_4_administration_requests",
    unresolved(
        "s_medication_administration", "medication_request_id", "s_medication_request"
    ),
)
expect(
    "slc_5_dispense_requests",
    unresolved("s_medication_dispense", "medication_request_id", "s_medication_request"),
)

# --- relationships --------------------------------------------------------

# Fixed by hand, not taken from the registry: source, column, target, key, label.
LINKS = (
    ("observation", "patient_id", "patient", "patient_id", "patient_id"),
    ("observation", "encounter_id", "encounter", "encounter_id", "encounter_id"),
    ("condition", "patient_id", "patient", "patient_id", "patient_id"),
    ("condition", "encounter_id", "encounter", "encounter_id", "encounter_id"),
    ("medication_ingredient", "medication_id", "medication", "medication_id", ""),
    (
        "medication_ingredient",
        "ingredient_medication_id",
        "medication",
        "medication_id",
        "",
    ),
    ("medication_request", "patient_id", "patient", "patient_id", "patient_id"),
    ("medication_request", "encounter_id", "encounter", "encounter_id", "encounter_id"),
    ("medication_request", "medication_id", "medication", "medication_id", ""),
    ("medication_administration", "patient_id", "patient", "patient_id", "patient_id"),
    (
        "medication_administration",
        "encounter_id",
        "encounter",
        "encounter_id",
        "encounter_id",
    ),
    (
        "medication_administration",
        "medication_request_id",
        "medication_request",
        "medication_request_id",
        "request_id",
    ),
    ("medication_dispense", "patient_id", "patient", "patient_id", "patient_id"),
    (
        "medication_dispense",
        "encounter_id",
        "encounter",
        "encounter_id",
        "encounter_id",
    ),
    (
        "medication_dispense",
        "medication_request_id",
        "medication_request",
        "medication_request_id",
        "request_id",
    ),
    ("medication_statement", "patient_id", "patient", "patient_id", "patient_id"),
    (
        "medication_statement",
        "encounter_id",
        "encounter",
        "encounter_id",
        "encounter_id",
    ),
    ("procedure", "patient_id", "patient", "patient_id", "patient_id"),
    ("procedure", "encounter_id", "encounter", "encounter_id", "encounter_id"),
)
WARNINGS = {
    "observation_missing_encounter_id": (
        "An observation may stand outside any encounter."
    ),
    "medication_administration_missing_encounter_id": (
        "An administration may come without its encounter."
    ),
    "medication_administration_missing_request_id": (
        "Administrations, in the ICU above all, may have no order."
    ),
    "medication_dispense_missing_request_id": (
        "Emergency dispenses come without an order."
    ),
}

ROWS = union(
    f"""SELECT '{n}_rows' AS metric, 'rows' AS kind, '{n}' AS table_name,
  count(*) AS value, CAST(NULL AS VARCHAR) AS warning FROM s_{n}"""
    for n in SILVER_NAMES
)
_missing = [
    (f"{source}_missing_{label}", source, f"{column} IS NULL")
    for source, column, _, _, label in LINKS
    if label
]
_missing.append(
    (
        "medication_request_missing_medication_concept",
        "medication_request",
        "medication_id IS NULL AND medication_code IS NULL",
    )
)
MISSING = union(
    f"""SELECT '{metric}' AS metric, 'missing' AS kind, '{source}' AS table_name,
  count(*) AS value, CAST({quoted(WARNINGS.get(metric))} AS VARCHAR) AS warning
FROM s_{source} WHERE {condition}"""
    for metric, source, condition in _missing
)
ORPHANS = union(
    f"""SELECT '{source}_orphan_{label or column}' AS metric, 'orphan' AS kind,
  '{source}' AS table_name, count(*) AS value, CAST(NULL AS VARCHAR) AS warning
FROM s_{source} WHERE {column} IS NOT NULL
  AND {column} NOT IN (SELECT {key} FROM s_{target} WHERE {key} IS NOT NULL)"""
    for source, column, target, key, label in LINKS
)
METRICS = union([ROWS, MISSING, ORPHANS])
expect("src_15_json_artifact", f"SELECT metric, kind, table_name, value FROM ({METRICS})")
for _key, _part in (
    ("rel_1_row_counts", ROWS),
    ("rel_2_missing_references", MISSING),
    ("rel_3_orphans", ORPHANS),
):
    expect(_key, f"SELECT metric, table_name, value FROM ({_part})")
expect("rel_4_table_presence", f"SELECT table_name, value > 0 AS has_rows FROM ({ROWS})")
expect(
    "rel_5_verdict",
    f"""SELECT {whole("sum(value)")} AS orphan_rows,
  count(*) FILTER (WHERE value > 0) AS orphan_metrics,
  coalesce(sum(value), 0) = 0 AS passed FROM ({ORPHANS})""",
)
_metric_names = [
    *[f"{n}_rows" for n in SILVER_NAMES],
    *[metric for metric, _, _ in _missing],
    *[f"{source}_orphan_{label or column}" for source, column, _, _, label in LINKS],
]
expect(
    "rel_5_wide_metrics",
    "SELECT "
    + ", ".join(
        f"{whole(f'''sum(value) FILTER (WHERE metric = '{name}')''')} AS {name}"
        for name in _metric_names
    )
    + f" FROM ({METRICS})",
)
REL_WARNINGS = f"""SELECT metric, value, warning FROM ({MISSING})
WHERE warning IS NOT NULL AND value > 0"""
expect("rel_6_warnings", REL_WARNINGS)

# --- privacy --------------------------------------------------------------

RULES = (
    "(VALUES "
    + ", ".join(
        f"({quoted(t)}, {quoted(c)}, {quoted(k)}, {quoted(r)}, {str(p).lower()})"
        for t, c, k, p, r in (
            *EXPECTED_RULES,
            *(
                (t, c, EXPECTED_LINEAGE_KIND, False, EXPECTED_LINEAGE_TEXT)
                for t in EXPECTED_TABLES
                for c in EXPECTED_LINEAGE
            ),
        )
    )
    + ") AS rules(table_name, column_name, classification, rationale, "
    "publishable_default)"
)
POPULATION = union(
    f"""SELECT '{t.name}' AS table_name,
  unnest([{", ".join(quoted(c) for c in t.columns)}]) AS column_name,
  unnest([{", ".join(f"count({c})" for c in t.columns)}]) AS populated_rows
FROM s_{t.name}"""
    for t in SILVER_TABLES
)
FINDINGS = f"""SELECT table_name, column_name, classification, rationale,
  populated_rows IS NOT NULL AS present, publishable_default,
  coalesce(populated_rows, 0) AS populated_rows
FROM {RULES} LEFT JOIN ({POPULATION}) USING (table_name, column_name)"""
expect(
    "prv_1_rules",
    f"""SELECT table_name, classification, publishable_default,
  count(*) AS rule_count, max(row_count) AS governed_rows
FROM {RULES} JOIN ({row_counts("s", SILVER_NAMES)}) USING (table_name)
GROUP BY 1, 2, 3""",
)
expect(
    "prv_2_rule_lookup",
    f"""SELECT table_name, column_name, classification, publishable_default,
  populated_rows
FROM ({POPULATION}) LEFT JOIN {RULES} USING (table_name, column_name)""",
)
expect("prv_3_column_findings", FINDINGS)
expect(
    "prv_3_findings_of_the_job",
    f"""SELECT table_name, column_name, classification, rationale, present,
  publishable_default FROM ({FINDINGS})""",
)
expect(
    "prv_8_classification_counts",
    f"""SELECT classification, count(*) AS column_count,
  {whole("sum(populated_rows)")} AS populated_values
FROM ({FINDINGS}) WHERE present GROUP BY 1""",
)


def matches(column: str, pattern: str) -> str:
    found = f"list_distinct(regexp_extract_all({column}, {quoted(pattern)}))"
    return f"coalesce(list_sort({found}), [])"


expect(
    "prv_4_pattern_matches",
    "SELECT * FROM ("
    + union(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"{column} AS text, row_count, "
        + ", ".join(
            f"array_to_string({matches(column, p)}, ' | ') AS {name}"
            for name, p in EXPECTED_PATTERNS.items()
        )
        + f" FROM (SELECT {column}, count(*) AS row_count FROM s_{table} "
        f"WHERE {column} IS NOT NULL GROUP BY 1)"
        for table, columns in EXPECTED_SCOPE.items()
        for column in columns
    )
    + ") WHERE "
    + " || ".join(EXPECTED_PATTERNS)
    + " <> ''",
)


def cell_counts(table: str, column: str, name: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  '{name}' AS pattern_name, count(*) FILTER (
    WHERE regexp_matches({column}, {quoted(EXPECTED_PATTERNS[name])})) AS match_count
FROM s_{table}"""


CELLS = union(
    cell_counts(table, column, name)
    for table, columns in EXPECTED_SCOPE.items()
    for column in columns
    for name in EXPECTED_PATTERNS
)
expect("prv_6_scan_scope", CELLS)


def cell_samples(table: str, column: str, name: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  '{name}' AS pattern_name, count(*) AS match_count,
  array_to_string(list_sort(list_distinct(flatten(list(found))))[1:5], ' | ')
    AS sample_matches
FROM (SELECT {matches(column, EXPECTED_PATTERNS[name])} AS found FROM s_{table}
  WHERE {column} IS NOT NULL) WHERE len(found) > 0 HAVING count(*) > 0"""


expect(
    "prv_5_column_scan",
    union(
        cell_samples(table, column, name)
        for table, columns in EXPECTED_SCOPE.items()
        for column in columns
        for name in EXPECTED_PATTERNS
    ),
)


def cell_first_samples(table: str, column: str, name: str) -> str:
    found = matches(column, EXPECTED_PATTERNS[name])
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  '{name}' AS pattern_name, any_value(n) AS match_count,
  array_to_string(list(match ORDER BY f, r, match)[1:5], ' | ') AS sample_matches
FROM (SELECT match, any_value(n) AS n, min(f) AS f, arg_min(r, (f, r)) AS r
  FROM (SELECT unnest(found) AS match, n, f, r
    FROM (SELECT *, count(*) OVER () AS n FROM (
      SELECT {found} AS found, source_file AS f, bronze_resource_id AS r FROM s_{table}
      WHERE {column} IS NOT NULL) WHERE len(found) > 0))
  GROUP BY match) HAVING count(*) > 0"""


expect(
    "prv_5_encounter_order",
    union(
        cell_first_samples(table, column, name)
        for table, columns in EXPECTED_SCOPE.items()
        for column in columns
        for name in EXPECTED_PATTERNS
    ),
)
VERDICT = f"""SELECT count(*) FILTER (WHERE match_count > 0) AS finding_count,
  CASE WHEN count(*) FILTER (WHERE match_count > 0) = 0 THEN 'passed'
       ELSE 'needs_review' END AS status FROM ({CELLS})"""
expect("prv_7_verdict", VERDICT)

# --- Gold -----------------------------------------------------------------

for _number, _gold in (
    (1, "encounter_summary"),
    (2, "condition_summary"),
    (3, "vitals_daily"),
    (4, "labs_daily"),
    (6, "medication_activity"),
    (7, "medication_order_fulfillment"),
    (8, "procedure_summary"),
):
    expect(f"gld_{_number}_{_gold}", f"SELECT * FROM g_{_gold}")
expect("gld_5_observation_daily", daily("code_system = 'obs-sys'"))
expect(
    "gld_9_stable_keys",
    """SELECT medication_request_id,
  md5('medication_request:' || medication_request_id) AS medication_request_key,
  md5('patient:' || patient_id) AS patient_key,
  md5('encounter:' || encounter_id) AS encounter_key FROM s_medication_request""",
)
expect(
    "gld_10_wall_clock",
    f"""SELECT encounter_id,
  CAST({instant("start_datetime")} AS VARCHAR) AS start_time,
  CAST({instant("end_datetime")} AS VARCHAR) AS end_time FROM s_encounter""",
)
expect(
    "gld_11_surface",
    f"""SELECT table_name, row_count, '' AS forbidden_columns
FROM ({row_counts("g", GOLD_NAMES)})""",
)
expect("gld_12_build_all", row_counts("g", GOLD_NAMES))

# --- quality --------------------------------------------------------------


def check(
    name: str,
    layer: str,
    passed: str,
    observed: str,
    expected: str,
    good: str,
    bad: str,
    source: str,
) -> str:
    return f"""SELECT {name} AS name, '{layer}' AS layer,
  CASE WHEN {passed} THEN 'pass' ELSE 'fail' END AS status,
  CAST({observed} AS VARCHAR) AS observed, {expected} AS expected,
  CASE WHEN {passed} THEN {quoted(good)} ELSE {quoted(bad)} END AS details
FROM {source}"""


BRONZE_CHECK = check(
    "'bronze_manifest_row_count'",
    "bronze",
    "true",
    "n",
    "'Bronze manifest validates against source inventory'",
    "every source file has all its rows",
    "",
    "(SELECT count(*) AS n FROM b_resources)",
)
PARITY_CHECKS = check(
    "'silver_' || table_name || '_row_count'",
    "silver",
    "actual_rows = expected_rows",
    "actual_rows",
    "expected_rows || ' rows from Bronze ' || resource_type",
    "one row per resource",
    "",
    f"({PARITY})",
)
# Fixed by hand: table -> required ids and how the check words them.
REQUIRED = {
    "patient": ("patient_id", "patient_id present"),
    "encounter": ("encounter_id patient_id", "encounter_id and patient_id present"),
    "observation": (
        "observation_id patient_id",
        "observation_id and patient_id present",
    ),
    "condition": ("condition_id patient_id", "condition_id and patient_id present"),
    "medication": ("medication_id", "medication_id present"),
    "medication_request": (
        "medication_request_id patient_id",
        "medication_request_id and patient_id present",
    ),
    "medication_administration": (
        "medication_administration_id patient_id",
        "medication_administration_id and patient_id present",
    ),
    "medication_dispense": (
        "medication_dispense_id patient_id",
        "medication_dispense_id and patient_id present",
    ),
    "medication_statement": (
        "medication_statement_id patient_id",
        "medication_statement_id and patient_id present",
    ),
    "procedure": (
        "procedure_id patient_id encounter_id",
        "procedure_id, patient_id, and encounter_id present",
    ),
}
REQUIRED_CHECKS = union(
    check(
        f"'{table}_required_ids'",
        "silver",
        "n = 0",
        "n",
        quoted(words),
        "all ids are there",
        "rows lack an id",
        f"(SELECT count(*) AS n FROM s_{table} WHERE "
        + " OR ".join(f"{c} IS NULL" for c in columns.split())
        + ")",
    )
    for table, (columns, words) in REQUIRED.items()
)
RELATION_CHECKS = union(
    [
        check(
            "'silver_relationship_orphans'",
            "relationships",
            "n = 0",
            "n",
            "'0 orphan populated references'",
            "every reference that is given leads to a row",
            "references lead to rows that do not exist",
            f"(SELECT {whole('sum(value)')} AS n FROM ({ORPHANS}))",
        ),
        f"""SELECT metric, 'relationships', 'warn', CAST(value AS VARCHAR),
  'reported optional coverage gap', warning FROM ({REL_WARNINGS})""",
    ]
)
PRIVACY_CHECK = check(
    "'privacy_pattern_findings'",
    "privacy",
    "finding_count = 0",
    "finding_count",
    "'0 unexpected pattern findings'",
    "no scanned field holds a match",
    "scanned fields hold matches to look at",
    f"({VERDICT})",
)
SURFACE_CHECKS = check(
    "'gold_' || table_name || '_surface'",
    "gold",
    "row_count > 0",
    "row_count",
    "'rows present and forbidden identifier columns absent'",
    "has rows and no forbidden column",
    "empty, or with a forbidden column",
    f"({row_counts('g', GOLD_NAMES)})",
)


def gold_check(name: str, expected: str, count: str) -> str:
    return check(
        f"'{name}'",
        "gold",
        "n = 0",
        "n",
        quoted(expected),
        "",
        "rows break the rule",
        f"(SELECT {count})",
    )


UNIQUE_CHECK = gold_check(
    "gold_encounter_unique_keys",
    "0 duplicate encounter keys",
    "count(*) - count(DISTINCT encounter_key) AS n FROM g_encounter_summary",
)
POSITIVE_CHECKS = union(
    gold_check(
        f"gold_{label}_positive_counts",
        "0 non-positive measurement counts",
        f"count(*) AS n FROM g_{label}_daily WHERE measurement_count <= 0",
    )
    for label in ("vitals", "labs")
)
ORDER_CHECKS = union(
    gold_check(
        f"gold_{label}_value_ordering",
        "0 rows with min/avg/max ordering errors",
        f"count(*) AS n FROM g_{label}_daily "
        "WHERE avg_value < min_value - 1e-9 OR avg_value > max_value + 1e-9",
    )
    for label in ("vitals", "labs")
)
ALL_CHECKS = union(
    [
        BRONZE_CHECK,
        PARITY_CHECKS,
        REQUIRED_CHECKS,
        RELATION_CHECKS,
        PRIVACY_CHECK,
        SURFACE_CHECKS,
        UNIQUE_CHECK,
        POSITIVE_CHECKS,
        ORDER_CHECKS,
    ]
)
REPORT = f"""SELECT
  CASE WHEN count(*) FILTER (WHERE status = 'fail') > 0 THEN 'failed'
       WHEN count(*) FILTER (WHERE status = 'warn') > 0 THEN 'warning'
       ELSE 'passed' END AS status,
  count(*) FILTER (WHERE status = 'fail') = 0 AS passed,
  count(*) AS check_count,
  count(*) FILTER (WHERE status = 'fail') AS failed_check_count,
  count(*) FILTER (WHERE status = 'warn') AS warning_check_count
FROM ({ALL_CHECKS})"""
expect("qlt_1_check_rows", ALL_CHECKS)
expect(
    "qlt_2_guarded_checks",
    f"""SELECT name, layer, status, observed, expected FROM ({PARITY_CHECKS})
UNION ALL SELECT 'silver_required_ids', 'silver', 'fail', 'KeyError',
  'check completes successfully'""",
)
expect("qlt_3_bronze_manifest", BRONZE_CHECK)
expect("qlt_4_row_parity", PARITY_CHECKS)
expect("qlt_5_required_ids", REQUIRED_CHECKS)
expect("qlt_6_relationships", RELATION_CHECKS)
expect("qlt_7_privacy", PRIVACY_CHECK)
expect("qlt_8_gold_surface", SURFACE_CHECKS)
expect("qlt_9_unique_encounters", UNIQUE_CHECK)
expect("qlt_10_positive_counts", POSITIVE_CHECKS)
expect("qlt_11_value_ordering", ORDER_CHECKS)
expect("qlt_12_report", REPORT)
expect(
    "qlt_13_layer_summary",
    f"""SELECT layer, status, count(*) AS check_count FROM ({ALL_CHECKS})
GROUP BY 1, 2""",
)
NAMED_ROWS = union(
    [
        "SELECT 'bronze' AS name, 'bronze' AS layer, count(*) AS n FROM b_resources",
        *[
            f"SELECT 'silver_{n}', 'silver', count(*) FROM s_{n}" for n in SILVER_NAMES
        ],
        *[f"SELECT 'gold_{n}', 'gold', count(*) FROM g_{n}" for n in GOLD_NAMES],
    ]
)
expect(
    "qlt_14_expected_counts",
    f"""SELECT name, layer, CASE WHEN n = wanted THEN 'pass' ELSE 'fail' END AS status,
  CAST(n AS VARCHAR) AS observed, CAST(wanted AS VARCHAR) AS expected
FROM ({NAMED_ROWS}) JOIN ({union([
        *[f"SELECT '{n}' AS name, count(*) AS wanted FROM {t}"
          for n, t in COUNTED_AS.items()],
        *[f"SELECT '{n}', {count}" for n, count in WRONG_COUNTS.items()],
    ])}) AS known USING (name)""",
)

# --- marts ----------------------------------------------------------------

MARTS: dict[str, str] = {}


def mart(name: str, sql: str) -> None:
    MARTS[name] = sql
    expect(name, sql)


mart(
    "mrt_1_encounters_by_class",
    """SELECT coalesce(encounter_class, 'unknown') AS label, count(*) AS value
FROM g_encounter_summary GROUP BY 1""",
)
mart(
    "mrt_2_discharge_dispositions",
    """SELECT coalesce(discharge_disposition, 'unknown') AS label, count(*) AS value
FROM g_encounter_summary GROUP BY 1 ORDER BY value DESC, label LIMIT 12""",
)
mart(
    "mrt_3_length_of_stay_bins",
    """SELECT CASE WHEN length_of_stay_hours IS NULL THEN 'unknown'
  WHEN length_of_stay_hours < 24 THEN '< 1 day'
  WHEN length_of_stay_hours < 72 THEN '1-3 days'
  WHEN length_of_stay_hours < 168 THEN '3-7 days' ELSE '7+ days' END AS label,
  count(*) AS value FROM g_encounter_summary GROUP BY 1""",
)
mart(
    "mrt_4_observation_load_bins",
    """SELECT CASE WHEN observation_count = 0 THEN '0'
  WHEN observation_count < 100 THEN '1-99'
  WHEN observation_count < 1000 THEN '100-999'
  WHEN observation_count < 5000 THEN '1k-5k' ELSE '5k+' END AS label,
  count(*) AS value FROM g_encounter_summary GROUP BY 1""",
)
expect(
    "mrt_5_top_conditions",
    """SELECT display AS label, count(DISTINCT patient_id) AS patient_count,
  count(DISTINCT encounter_id) AS encounter_count, count(*) AS value
FROM s_condition WHERE display IS NOT NULL GROUP BY 1
ORDER BY value DESC, patient_count DESC, label LIMIT 12""",
)


def volume(label: str) -> str:
    return f"""SELECT measurement_name AS label,
  {whole("sum(measurement_count)")} AS value FROM g_{label}_daily GROUP BY 1"""


def trend(source: str) -> str:
    return f"""
WITH week AS (
  SELECT measurement_name, event_day_index, round(avg(avg_value), 2) AS avg_value,
    {whole("sum(measurement_count)")} AS measurement_count
  FROM {source} WHERE event_day_index BETWEEN 0 AND 7 GROUP BY 1, 2
)
SELECT measurement_name, event_day_index, avg_value,
  round(avg_value / nullif(first_value(avg_value) OVER (
    PARTITION BY measurement_name ORDER BY event_day_index), 0) * 100, 2)
    AS index_value,
  measurement_count
FROM week"""


mart("mrt_6_vitals_volume", volume("vitals"))
mart("mrt_7_labs_volume", f"{volume('labs')} ORDER BY value DESC, label LIMIT 15")
mart("mrt_8_vitals_trend", trend("g_vitals_daily"))
mart(
    "mrt_9_labs_trend",
    trend(
        f"""(SELECT * FROM g_labs_daily WHERE measurement_name IN (
    SELECT label FROM ({volume("labs")} ORDER BY value DESC, label LIMIT 6)))"""
    ),
)
mart(
    "mrt_10_medication_by_activity",
    f"""SELECT activity_type AS label, {whole("sum(event_count)")} AS value
FROM g_medication_activity GROUP BY 1""",
)
mart(
    "mrt_11_top_medications",
    f"""SELECT medication_display AS label, activity_type, source_system,
  {whole("sum(event_count)")} AS value, {whole("sum(patient_count)")} AS patient_count,
  {whole("sum(encounter_count)")} AS encounter_count
FROM g_medication_activity WHERE medication_display IS NOT NULL GROUP BY 1, 2, 3
ORDER BY value DESC, label, activity_type, source_system LIMIT 15""",
)
mart(
    "mrt_12_fulfillment_paths",
    """SELECT fulfillment_path AS label, count(*) AS value
FROM g_medication_order_fulfillment GROUP BY 1""",
)
mart(
    "mrt_13_top_procedures",
    f"""SELECT procedure_display AS label, source_system,
  {whole("sum(procedure_count)")} AS value,
  {whole("sum(patient_count)")} AS patient_count,
  {whole("sum(encounter_count)")} AS encounter_count
FROM g_procedure_summary WHERE procedure_display IS NOT NULL GROUP BY 1, 2
ORDER BY value DESC, label, source_system LIMIT 15""",
)
expect(
    "mrt_14_table_counts",
    union(
        [
            """SELECT 'Bronze' AS layer, 'fhir_resources' AS "table", count(*) AS "rows"
FROM b_resources""",
            *[f"SELECT 'Silver', '{n}', count(*) FROM s_{n}" for n in SILVER_NAMES],
            *[f"SELECT 'Gold', '{n}', count(*) FROM g_{n}" for n in GOLD_NAMES],
        ]
    ),
)


def rows_of(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


HEADLINE = f"""SELECT {rows_of("b_resources")} AS source_resources,
  {rows_of("s_patient")} AS patients, {rows_of("s_encounter")} AS encounters,
  {rows_of("s_observation")} AS observations, {rows_of("s_condition")} AS conditions,
  {rows_of("s_medication_request")} + {rows_of("s_medication_administration")}
  + {rows_of("s_medication_dispense")} + {rows_of("s_medication_statement")}
    AS medication_events,
  {rows_of("s_procedure")} AS procedures, status AS quality_status,
  failed_check_count AS failed_checks, warning_check_count AS warning_checks
FROM ({REPORT})"""
expect("mrt_15_headline_metrics", HEADLINE)
expect(
    "mrt_16_mart_validation",
    union(
        [
            *[
                f"""SELECT '{name.split("_", 2)[2]} is not empty' AS assertion,
  count(*) AS observed, count(*) > 0 AS passed FROM ({sql})"""
                for name, sql in MARTS.items()
            ],
            f"""SELECT 'no failed checks', failed_check_count, failed_check_count = 0
FROM ({REPORT})""",
            f"""SELECT 'references resolve', {whole("sum(value)")},
  coalesce(sum(value), 0) = 0 FROM ({ORPHANS})""",
            f"""SELECT 'patients as expected', count(*),
  count(*) = (SELECT count(*) FROM customer) FROM s_patient""",
            """SELECT 'procedures as expected', count(*), count(*) = 1
FROM s_procedure""",
        ]
    ),
)

# --- job ------------------------------------------------------------------


def total_of(layer: str, names) -> str:
    return "(SELECT " + " + ".join(rows_of(f"{layer}_{n}") for n in names) + ")"


STEPS = f"""
SELECT 1 AS step, 'source_profile' AS name, 'success' AS status,
  {rows_of("b_resources")} AS "rows"
UNION ALL SELECT 2, 'bronze', 'success', {rows_of("b_resources")}
UNION ALL SELECT 3, 'silver', 'success', {total_of("s", SILVER_NAMES)}
UNION ALL SELECT 4, 'relationships', 'success',
  (SELECT {whole("sum(value)")} FROM ({ORPHANS}))
UNION ALL SELECT 5, 'privacy', 'success', (SELECT finding_count FROM ({VERDICT}))
UNION ALL SELECT 6, 'gold', 'success', {total_of("g", GOLD_NAMES)}
UNION ALL SELECT 7, 'quality', 'failed', 0"""
JOB_LOG = f"""SELECT count(*) AS steps,
  count(*) FILTER (WHERE status = 'success') AS succeeded,
  max_by(name, step) AS last_step,
  CASE WHEN bool_and(status = 'success') THEN 'success' ELSE 'failed' END AS status,
  'QualityGateError' AS error_type FROM ({STEPS})"""
for _key, _sql in (("job_1_pipeline", STEPS), ("job_2_run_log", JOB_LOG)):
    # The landed files hold no dangling order and medication links.
    ORACLES[_key] = (
        with_tables(_sql)
        .replace("WHEN o_orderkey % 331 = 0 THEN 'm-x'", "")
        .replace("WHEN l_partkey % 67 = 0 THEN 'r-x'", "")
    )

expect(
    "job_1_clean_pipeline",
    f"""SELECT step, name, 'success' AS status,
  name NOT IN ('relationships', 'privacy') AS has_rows
FROM (SELECT step, name FROM ({STEPS}))""",
)

__all__ = ["ORACLES"]
