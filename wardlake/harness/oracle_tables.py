"""Expected layer tables as SQL over the flat test tables.

Written against the flat columns alone: no JSON is built or parsed, so these
statements are independent of the Spark code they check. ``s_`` tables are
Silver, ``g_`` tables Gold.
"""

from __future__ import annotations

import re

PROFILE = "http://example.org/fhir/StructureDefinition/"


def lineage(family: str, kind: str, key: str, no_profile: str = "false") -> str:
    return f"""
      ({family}) || '.ndjson.gz' AS source_file,
      {family} AS resource_family,
      CASE WHEN {no_profile} THEN NULL ELSE '{PROFILE}{kind.lower()}' END AS profile_url,
      'star-schema-clinic' AS source_dataset_name,
      '1.0' AS source_dataset_version,
      '2024-01-01T00:00:00+00:00' AS bronze_ingested_at,
      {key} AS bronze_resource_id"""


def iso(ts: str, offset: str = "") -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '{offset}')"


def line_key(prefix: str) -> str:
    return (
        f"('{prefix}-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey "
        "|| '-' || l_suppkey)"
    )


LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
START = (
    "(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) "
    "+ to_minutes(CAST(o_orderkey % 60 AS INTEGER)))"
)
END = (
    f"({START} + to_hours(CAST(o_custkey % 200 AS INTEGER)) "
    "+ to_minutes(CAST(o_orderkey % 90 AS INTEGER)))"
)
LINE_TIME = "(l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)))"
VITALS = (
    "['Heart Rate', 'Respiratory Rate', 'O2 saturation pulseoxymetry', "
    "'Temperature Fahrenheit', 'Non Invasive Blood Pressure systolic', "
    "'Non Invasive Blood Pressure diastolic', 'Non Invasive Blood Pressure mean']"
)

PATIENT = f"""
SELECT
  'c-' || c_custkey AS patient_id,
  CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey AS VARCHAR) END
    AS source_patient_identifier,
  CASE WHEN c_custkey % 19 <> 0 THEN c_name END AS synthetic_patient_name,
  CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
  strftime(DATE '1930-01-01' + CAST(c_custkey * 37 % 30000 AS INTEGER), '%Y-%m-%d')
    AS birth_date,
  CASE WHEN c_custkey % 23 = 0 THEN '2020-01-01T00:00:00-05:00' END
    AS deceased_datetime,
  CASE WHEN c_custkey % 31 <> 0 AND c_custkey % 7 <> 0 THEN n_name END AS race,
  CASE WHEN c_custkey % 31 = 0 THEN NULL
       WHEN c_custkey % 5 = 0 THEN r_name
       ELSE 'E' || r_regionkey END AS ethnicity,
  CASE WHEN c_custkey % 31 = 0 OR c_custkey % 29 = 0 THEN NULL
       WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS birth_sex,
  CASE WHEN c_custkey % 37 <> 0 THEN c_mktsegment END AS marital_status_code,
  {lineage("'MimicPatient'", "Patient", "'c-' || c_custkey")}
FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""

ENCOUNTER_FAMILY = (
    "CASE o_orderkey % 10 WHEN 0 THEN 'MimicEncounterED' "
    "WHEN 1 THEN 'MimicEncounterICU' ELSE 'MimicEncounter' END"
)
ENCOUNTER = f"""
SELECT
  'o-' || o_orderkey AS encounter_id,
  CASE WHEN o_orderkey % 31 = 0 THEN 'c-' || o_custkey
       WHEN o_orderkey % 37 = 0 THEN NULL
       WHEN o_orderkey % 41 = 0 THEN 'c-' || o_custkey
       WHEN o_orderkey % 47 = 0 THEN ''
       ELSE 'c-' || o_custkey END AS patient_id,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress'
       ELSE 'planned' END AS status,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS class_code,
  CASE WHEN o_orderkey % 29 <> 0 THEN lower(o_orderpriority) END AS class_display,
  CASE WHEN o_orderkey % 113 = 0 THEN NULL
       WHEN o_orderkey % 101 = 7 THEN 'unknown'
       WHEN o_orderkey % 103 = 5 THEN strftime({START}, '%Y-%m')
       WHEN o_orderkey % 107 = 3 THEN strftime({START}, '%Y-%m-%d')
       ELSE {iso(START, "-04:00")} END AS start_datetime,
  CASE WHEN o_orderkey % 113 = 0 OR o_orderkey % 17 = 0 THEN NULL
       WHEN o_orderkey % 109 = 1 THEN strftime({END}, '%Y-%m-%d') || 'T24:00:00'
       ELSE {iso(END, "-04:00")} END AS end_datetime,
  CASE WHEN o_orderkey % 59 <> 0 THEN 'S' || (o_orderkey % 5) END
    AS service_type_code,
  CASE WHEN o_orderkey % 53 <> 0 THEN 'A' || (o_orderkey % 4) END AS admit_source,
  CASE WHEN o_orderkey % 53 <> 0 AND o_orderkey % 10 <> 3 THEN 'D-' || o_orderstatus
    END AS discharge_disposition,
  CASE WHEN o_orderkey % 53 <> 0 THEN 'Disposition ' || o_orderstatus END
    AS discharge_disposition_display,
  {lineage(ENCOUNTER_FAMILY, "Encounter", "'o-' || o_orderkey")}
FROM orders
"""

LAB = "l_returnflag = 'A'"
LINE_OBSERVATION_FAMILY = (
    f"CASE WHEN {LAB} THEN 'MimicObservationLabevents' "
    "ELSE 'MimicObservationChartevents' END"
)
EVENT_NUMBER = """
  CASE event_id % 8
    WHEN 0 THEN CAST(value AS VARCHAR)
    WHEN 7 THEN CAST(value AS VARCHAR)
    WHEN 1 THEN CAST(CAST(CAST(value AS DECIMAL(12,2)) * 10000000 AS DOUBLE) AS VARCHAR)
    WHEN 2 THEN CAST(CAST(CAST(value AS DECIMAL(12,2)) || 'e-5' AS DOUBLE) AS VARCHAR)
    WHEN 3 THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
  END"""
OBSERVATION = f"""
SELECT
  {line_key("l")} AS observation_id,
  CASE WHEN l_partkey % 89 = 0 THEN 'x-' ELSE 'c-' END || o_custkey AS patient_id,
  CASE WHEN l_partkey % 13 = 0 THEN NULL
       WHEN l_partkey % 97 = 0 THEN 'z-' || l_orderkey
       ELSE 'o-' || l_orderkey END AS encounter_id,
  'final' AS status,
  CASE WHEN l_partkey % 83 <> 0 THEN {iso(LINE_TIME, "-05:00")} END
    AS effective_datetime,
  strftime({LINE_TIME}, '%Y-%m-%d') AS issued_datetime,
  CASE WHEN NOT {LAB} THEN 'vital-signs'
       WHEN l_linenumber % 2 = 0 THEN 'laboratory' ELSE 'Labs' END AS category_code,
  'cat-sys' AS category_system,
  CASE WHEN {LAB} THEN 'Laboratory' ELSE 'Vital Signs' END AS category_display,
  CASE WHEN {LAB} THEN 'L' || (l_suppkey % 20) ELSE 'V' || (l_linenumber % 7) END
    AS code,
  'obs-sys' AS code_system,
  CASE WHEN {LAB} THEN 'Lab test ' || (l_suppkey % 20)
       ELSE {VITALS}[l_linenumber % 7 + 1] END AS display,
  CASE WHEN l_partkey % 71 = 0 OR l_partkey % 73 = 0 THEN 'string' ELSE 'quantity' END
    AS value_type,
  CASE WHEN l_partkey % 71 = 0 THEN 'not numeric'
       WHEN l_partkey % 73 = 0 THEN '12.5'
       ELSE CAST(l_quantity AS VARCHAR) END AS value,
  CASE WHEN l_partkey % 71 = 0 OR l_partkey % 73 = 0 THEN NULL
       WHEN {LAB} AND l_linenumber % 3 = 0 THEN 'mg/dL'
       WHEN {LAB} THEN 'mmol/L'
       ELSE 'u' || (l_linenumber % 7) END AS unit,
  CASE WHEN {LAB} THEN 's-' || l_suppkey END AS specimen_id,
  {lineage(LINE_OBSERVATION_FAMILY, "Observation", line_key("l"))}
FROM {LINES}
UNION ALL
SELECT
  'e-' || event_id,
  'c-' || user_id,
  NULL,
  'preliminary',
  {iso("ts")},
  NULL,
  CASE WHEN event_type = 'click' THEN 'exam' END,
  NULL, NULL, NULL, NULL,
  'Event ' || event_type,
  CASE WHEN event_id % 8 IN (0, 1, 2, 3, 7) THEN 'quantity'
       WHEN event_id % 8 = 4 THEN 'string'
       WHEN event_id % 8 = 5 THEN 'component' END,
  CASE WHEN event_id % 8 = 4 THEN 'text ' || event_id ELSE {EVENT_NUMBER} END,
  CASE WHEN event_id % 8 IN (0, 1, 2, 3) THEN 'u'
       WHEN event_id % 8 = 7 THEN 'mmHg' END,
  NULL,
  {lineage("'MimicObservationVitalSignsED'", "Observation", "'e-' || event_id")}
FROM events WHERE event_type IN ('error', 'click')
UNION ALL
SELECT
  'd-' || doc_id,
  CASE WHEN doc_id % 10 <> 0 THEN 'c-' || (doc_id % 100) END,
  NULL, 'final', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  'Note', 'string', text, NULL, NULL,
  {lineage("'MimicObservationNotes'", "Observation", "'d-' || doc_id")}
FROM documents
"""

CONDITION_FAMILY = (
    "CASE WHEN l_linenumber % 5 = 0 THEN 'MimicConditionED' ELSE 'MimicCondition' END"
)
CONDITION = f"""
SELECT
  {line_key("k")} AS condition_id,
  'c-' || o_custkey AS patient_id,
  CASE WHEN l_suppkey % 50 <> 0 THEN 'o-' || l_orderkey END AS encounter_id,
  'encounter-diagnosis' AS category_code,
  'cs' AS category_system,
  CAST(NULL AS VARCHAR) AS category_display,
  p_brand AS code,
  'icd' AS code_system,
  CASE WHEN p_size % 10 <> 0 THEN p_type END AS display,
  {lineage(CONDITION_FAMILY, "Condition", line_key("k"))}
FROM {LINES} JOIN part ON l_partkey = p_partkey
WHERE l_linestatus = 'F'
"""

MEDICATION_FAMILY = (
    "CASE WHEN p_size % 5 = 0 AND p_partkey % 2 = 0 THEN 'MimicMedicationMix' "
    "ELSE 'MimicMedication' END"
)
MEDICATION_NAME = (
    "CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 8 <> 0 THEN p_name END"
)
MEDICATION = f"""
SELECT
  'm-' || p_partkey AS medication_id,
  CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS medication_code,
  CASE WHEN p_partkey % 50 <> 0 THEN 'ndc' END AS medication_code_system,
  CASE WHEN p_partkey % 50 = 0 THEN {MEDICATION_NAME}
       WHEN p_partkey % 3 = 0 THEN p_name
       WHEN p_partkey % 6 = 1 THEN p_type
       ELSE {MEDICATION_NAME} END AS medication_display,
  CASE WHEN p_partkey % 50 <> 0 AND p_partkey % 6 = 1 THEN p_type END
    AS medication_text,
  'F' || (p_size % 4) AS form_code,
  'Form ' || (p_size % 4) AS form_display,
  p_size % 5 = 0 AS is_mix,
  CAST(CASE WHEN p_partkey % 9 = 0 THEN 0 WHEN p_partkey % 8 = 0 THEN 1 ELSE 2 END
    AS BIGINT) AS identifier_count,
  CAST(CASE WHEN p_size % 10 = 0 THEN 3 WHEN p_size % 5 = 0 THEN 1 ELSE 0 END
    AS BIGINT) AS ingredient_count,
  {lineage(MEDICATION_FAMILY, "Medication", "'m-' || p_partkey")}
FROM part
"""
INGREDIENT = f"""
SELECT
  'm-' || p_partkey AS medication_id,
  CAST(0 AS BIGINT) AS ingredient_index,
  CASE WHEN p_partkey % 61 = 0 THEN 'm-x' ELSE 'm-' END || (p_partkey + 1)
    AS ingredient_medication_id,
  CAST(NULL AS VARCHAR) AS ingredient_code,
  CAST(NULL AS VARCHAR) AS ingredient_code_system,
  CAST(NULL AS VARCHAR) AS ingredient_display,
  CAST(p_size AS VARCHAR) AS strength_numerator_value,
  'mg' AS strength_numerator_unit,
  '1.5' AS strength_denominator_value,
  'mL' AS strength_denominator_unit,
  {lineage(MEDICATION_FAMILY, "Medication", "'m-' || p_partkey")}
FROM part WHERE p_size % 5 = 0
UNION ALL
SELECT
  'm-' || p_partkey, 2, NULL, p_brand, NULL, p_type, NULL, NULL, NULL, NULL,
  {lineage(MEDICATION_FAMILY, "Medication", "'m-' || p_partkey")}
FROM part WHERE p_size % 10 = 0
"""

REQUEST = f"""
WITH r AS (
  SELECT *, o_orderkey AS k,
    CASE WHEN o_orderkey % 2 <> 0 THEN NULL
         WHEN o_orderkey % 331 = 0 THEN 'm-x'
         ELSE 'm-' || (o_orderkey % 200) END AS medication_ref,
    o_orderkey % 2 = 1 AND o_orderkey % 21 <> 0 AS inline_concept
  FROM orders
)
SELECT
  'r-' || k AS medication_request_id,
  'c-' || o_custkey AS patient_id,
  CASE WHEN k % 23 <> 0 THEN 'o-' || k END AS encounter_id,
  CASE WHEN k % 2 = 0 THEN 'completed' ELSE 'active' END AS status,
  'order' AS intent,
  CASE WHEN k % 79 = 0 THEN '2180' ELSE {iso("o_orderdate", "-05:00")} END
    AS authored_datetime,
  medication_ref AS medication_id,
  CASE WHEN inline_concept THEN 'C' || (k % 40) ELSE m.medication_code END
    AS medication_code,
  CASE WHEN inline_concept THEN 'loc' ELSE m.medication_code_system END
    AS medication_code_system,
  CASE WHEN inline_concept AND k % 6 = 1 THEN 'Text ' || (k % 40)
       WHEN inline_concept THEN 'Drug ' || (k % 40)
       ELSE m.medication_display END AS medication_display,
  CASE WHEN k % 2 = 0 THEN 'reference' ELSE 'inline_code' END
    AS medication_source_type,
  CASE WHEN k % 5 <> 0 THEN 'IV' END AS route_code,
  CASE WHEN k % 5 <> 0 THEN 'Intravenous' END AS route_display,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN CAST(o_totalprice AS VARCHAR)
       WHEN k % 3 = 1 THEN '9' END AS dose_value,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN 'mg' WHEN k % 3 = 1 THEN 'x' END
    AS dose_unit,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN 'BID'
       ELSE CAST(k % 4 AS VARCHAR) END AS frequency,
  CASE WHEN k % 5 <> 0 AND k % 3 <> 0 THEN '1.5' END AS period,
  CASE WHEN k % 5 <> 0 AND k % 3 <> 0 THEN 'd' END AS period_unit,
  CASE WHEN k % 7 <> 0 THEN {iso("o_orderdate")} END AS validity_start_datetime,
  CASE WHEN k % 7 <> 0 THEN '2030-01-01' END AS validity_end_datetime,
  CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE 2 END AS BIGINT) AS dosage_instruction_count,
  {lineage("'MimicMedicationRequest'", "MedicationRequest", "'r-' || k")}
FROM r LEFT JOIN s_medication m ON medication_ref = m.medication_id
"""

ADMINISTRATION_FAMILY = (
    "CASE WHEN l_linenumber % 4 = 0 THEN 'MimicMedicationAdministrationICU' "
    "ELSE 'MimicMedicationAdministration' END"
)
SHIPPED = iso("l_shipdate", "-05:00")
SHIPPED_LATER = iso("(l_shipdate + INTERVAL 150 MINUTE)", "-05:00")
ADMINISTRATION = f"""
SELECT
  {line_key("a")} AS medication_administration_id,
  'c-' || o_custkey AS patient_id,
  CASE WHEN l_partkey % 11 <> 0 THEN 'o-' || l_orderkey END AS encounter_id,
  'completed' AS status,
  'inpatient' AS category_code,
  'Inpatient' AS category_display,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE {SHIPPED} END
    AS effective_start_datetime,
  CASE WHEN l_linenumber IN (2, 4) THEN {SHIPPED_LATER} END AS effective_end_datetime,
  CASE WHEN l_partkey % 59 <> 0 THEN 'B' || (l_partkey % 30) END AS medication_code,
  CASE WHEN l_partkey % 59 <> 0 THEN 'emar' END AS medication_code_system,
  CASE WHEN l_partkey % 59 <> 0 THEN 'Med ' || (l_partkey % 30) END
    AS medication_display,
  CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 67 = 0 THEN 'r-x'
       ELSE 'r-' || l_orderkey END AS medication_request_id,
  CASE WHEN l_suppkey % 9 <> 0 THEN CAST(l_quantity AS VARCHAR) END AS dose_value,
  CASE WHEN l_suppkey % 9 <> 0 THEN 'mL' END AS dose_unit,
  CASE WHEN l_suppkey % 9 <> 0 THEN 'PUSH' END AS method_code,
  CASE WHEN l_suppkey % 9 <> 0 THEN 'IV Push' END AS method_display,
  CASE WHEN l_linenumber % 4 = 0 THEN 'icu' ELSE 'hospital' END AS source_system,
  l_partkey % 7 <> 0 AS has_request_reference,
  l_partkey % 11 <> 0 AS has_encounter_context,
  {lineage(ADMINISTRATION_FAMILY, "MedicationAdministration", line_key("a"))}
FROM {LINES} WHERE l_returnflag = 'A'
"""

DISPENSE_FAMILY = (
    "CASE WHEN l_linenumber % 5 = 0 THEN 'MimicMedicationDispenseED' "
    "ELSE 'MimicMedicationDispense' END"
)
DISPENSE = f"""
SELECT
  {line_key("p")} AS medication_dispense_id,
  'c-' || o_custkey AS patient_id,
  CASE WHEN l_partkey % 10 <> 0 THEN 'o-' || l_orderkey END AS encounter_id,
  'completed' AS status,
  {SHIPPED} AS when_handed_over_datetime,
  CASE WHEN l_partkey % 3 <> 0 THEN 'N' || (l_partkey % 20) END AS medication_code,
  CASE WHEN l_partkey % 3 <> 0 THEN 'ndc' END AS medication_code_system,
  CASE WHEN l_partkey % 3 = 0 THEN 'Dispensed ' ELSE 'Pill ' END || (l_partkey % 20)
    AS medication_display,
  'Dispensed ' || (l_partkey % 20) AS medication_text,
  CASE WHEN l_partkey % 7 NOT IN (0, 2) THEN 'r-' || l_orderkey END
    AS medication_request_id,
  CAST(CASE l_partkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END
    AS BIGINT) AS authorizing_prescription_count,
  'PO' AS route_code,
  'Oral' AS route_display,
  CAST(l_linenumber AS VARCHAR) AS frequency,
  '1' AS period,
  'h' AS period_unit,
  CASE WHEN l_linenumber % 5 = 0 THEN 'ed' ELSE 'inpatient' END AS source_system,
  l_partkey % 7 NOT IN (0, 2) AS has_request_reference,
  {lineage(DISPENSE_FAMILY, "MedicationDispense", line_key("p"))}
FROM {LINES} WHERE l_returnflag = 'R'
"""

STATEMENT_LINEAGE = lineage(
    "'MimicMedicationStatementED'",
    "MedicationStatement",
    "'s-' || event_id",
    "event_id % 11 = 0",
)
STATEMENT = f"""
SELECT
  's-' || event_id AS medication_statement_id,
  'c-' || user_id AS patient_id,
  CASE WHEN event_id % 2 <> 0 THEN 'o-' || event_id END AS encounter_id,
  'unknown' AS status,
  {iso("ts")} AS date_asserted_datetime,
  CASE WHEN event_id % 3 <> 0 THEN 'H' || (event_id % 25) END AS medication_code,
  CASE WHEN event_id % 3 <> 0 THEN 'gsn' END AS medication_code_system,
  CASE WHEN event_id % 3 = 0 THEN 'Home med ' ELSE 'Named ' END || (event_id % 25)
    AS medication_display,
  'Home med ' || (event_id % 25) AS medication_text,
  'ed' AS source_system,
  {STATEMENT_LINEAGE}
FROM events WHERE event_type = 'view'
"""

PROCEDURE_FAMILY = (
    "CASE event_id % 6 WHEN 0 THEN 'MimicProcedureED' WHEN 1 THEN 'MimicProcedureICU' "
    "ELSE 'MimicProcedure' END"
)
PROCEDURE = f"""
SELECT
  'q-' || event_id AS procedure_id,
  'c-' || user_id AS patient_id,
  CASE WHEN event_id % 500 <> 0 THEN 'o-' || event_id END AS encounter_id,
  'completed' AS status,
  {iso("ts")} AS performed_start_datetime,
  CASE WHEN event_type = 'signup' THEN {iso("(ts + INTERVAL 1 HOUR)")} END
    AS performed_end_datetime,
  'surgery' AS category_code,
  'Surgery' AS category_display,
  'P' || (event_id % 15) AS procedure_code,
  'proc' AS procedure_code_system,
  CASE WHEN event_id % 4 = 0 THEN 'Procedure ' ELSE 'Named procedure ' END
    || (event_id % 15) AS procedure_display,
  CASE WHEN event_id % 2 = 0 THEN 'BS' || (event_id % 3) END AS body_site_code,
  CASE WHEN event_id % 2 = 0 THEN 'Site ' || (event_id % 3) END AS body_site_display,
  CASE event_id % 6 WHEN 0 THEN 'ed' WHEN 1 THEN 'icu' ELSE 'hospital' END
    AS source_system,
  {lineage(PROCEDURE_FAMILY, "Procedure", "'q-' || event_id")}
FROM events WHERE event_type IN ('purchase', 'signup')
"""

SILVER_SQL = {
    "s_patient": PATIENT,
    "s_encounter": ENCOUNTER,
    "s_observation": OBSERVATION,
    "s_condition": CONDITION,
    "s_medication": MEDICATION,
    "s_medication_ingredient": INGREDIENT,
    "s_medication_request": REQUEST,
    "s_medication_administration": ADMINISTRATION,
    "s_medication_dispense": DISPENSE,
    "s_medication_statement": STATEMENT,
    "s_procedure": PROCEDURE,
}
RESOURCE_TYPES = {
    "s_patient": "Patient",
    "s_encounter": "Encounter",
    "s_observation": "Observation",
    "s_condition": "Condition",
    "s_medication": "Medication",
    "s_medication_request": "MedicationRequest",
    "s_medication_administration": "MedicationAdministration",
    "s_medication_dispense": "MedicationDispense",
    "s_medication_statement": "MedicationStatement",
    "s_procedure": "Procedure",
}

# Every resource once: what Bronze must hold, without the raw text.
BRONZE = " UNION ALL ".join(
    f"""SELECT '{kind}' AS resource_type, bronze_resource_id AS resource_id,
      source_file, resource_family, profile_url, source_dataset_name,
      source_dataset_version, bronze_ingested_at AS ingested_at FROM {table}"""
    for table, kind in RESOURCE_TYPES.items()
)


def instant(column: str) -> str:
    return f"TRY_CAST(substr({column}, 1, 19) AS TIMESTAMP)"


def events_of(columns: str, tables: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT {columns} FROM {table}" for table in tables)


MEDICATION_TABLES = (
    "s_medication_request",
    "s_medication_administration",
    "s_medication_dispense",
    "s_medication_statement",
)


def encounter_counts(column: str, table: str) -> str:
    return f"""(SELECT encounter_id, count(*) AS {column} FROM {table}
      WHERE encounter_id IS NOT NULL GROUP BY encounter_id)"""


G_ENCOUNTER = f"""
SELECT
  md5('encounter:' || e.encounter_id) AS encounter_key,
  md5('patient:' || e.patient_id) AS patient_key,
  e.status AS encounter_status,
  e.class_code AS encounter_class,
  e.class_display AS encounter_class_display,
  CAST(date_part('year', {instant("e.start_datetime")}) AS INTEGER)
    AS encounter_start_year,
  CAST(date_part('month', {instant("e.start_datetime")}) AS INTEGER)
    AS encounter_start_month,
  CAST(date_diff('hour', {instant("e.start_datetime")}, {instant("e.end_datetime")})
    AS BIGINT) AS length_of_stay_hours,
  coalesce(observation_count, 0) AS observation_count,
  coalesce(condition_count, 0) AS condition_count,
  coalesce(distinct_condition_count, 0) AS distinct_condition_count,
  coalesce(medication_request_count, 0) AS medication_request_count,
  coalesce(medication_administration_count, 0) AS medication_administration_count,
  coalesce(medication_dispense_count, 0) AS medication_dispense_count,
  coalesce(medication_statement_count, 0) AS medication_statement_count,
  coalesce(procedure_count, 0) AS procedure_count,
  coalesce(distinct_medication_count, 0) AS distinct_medication_count,
  coalesce(distinct_procedure_count, 0) AS distinct_procedure_count,
  e.discharge_disposition
FROM s_encounter e
LEFT JOIN {encounter_counts("observation_count", "s_observation")} o
  ON o.encounter_id = e.encounter_id
LEFT JOIN (
  SELECT encounter_id, count(*) AS condition_count,
    count(DISTINCT coalesce(code, '') || '|' || coalesce(display, ''))
      AS distinct_condition_count
  FROM s_condition WHERE encounter_id IS NOT NULL GROUP BY encounter_id
) c ON c.encounter_id = e.encounter_id
LEFT JOIN {encounter_counts("medication_request_count", "s_medication_request")} mr
  ON mr.encounter_id = e.encounter_id
LEFT JOIN {encounter_counts(
    "medication_administration_count", "s_medication_administration")} ma
  ON ma.encounter_id = e.encounter_id
LEFT JOIN {encounter_counts("medication_dispense_count", "s_medication_dispense")} md
  ON md.encounter_id = e.encounter_id
LEFT JOIN {encounter_counts("medication_statement_count", "s_medication_statement")} ms
  ON ms.encounter_id = e.encounter_id
LEFT JOIN (
  SELECT encounter_id, count(DISTINCT coalesce(medication_code, '') || '|'
    || coalesce(medication_display, '')) AS distinct_medication_count
  FROM ({events_of("encounter_id, medication_code, medication_display",
                   MEDICATION_TABLES)})
  WHERE encounter_id IS NOT NULL GROUP BY encounter_id
) mc ON mc.encounter_id = e.encounter_id
LEFT JOIN (
  SELECT encounter_id, count(*) AS procedure_count,
    count(DISTINCT coalesce(procedure_code, '') || '|'
      || coalesce(procedure_display, '')) AS distinct_procedure_count
  FROM s_procedure WHERE encounter_id IS NOT NULL GROUP BY encounter_id
) p ON p.encounter_id = e.encounter_id
"""

G_CONDITION = """
SELECT c.code AS condition_code, c.display AS condition_display,
  e.class_code AS encounter_class, e.class_display AS encounter_class_display,
  count(DISTINCT c.patient_id) AS patient_count,
  count(DISTINCT c.encounter_id) AS encounter_count,
  count(*) AS condition_row_count
FROM s_condition c LEFT JOIN s_encounter e ON e.encounter_id = c.encounter_id
GROUP BY 1, 2, 3, 4
"""


def daily(where: str) -> str:
    return f"""
WITH kept AS (
  SELECT patient_id, encounter_id, display, unit,
    TRY_CAST(value AS DOUBLE) AS number, {instant("effective_datetime")} AS seen_at
  FROM s_observation
  WHERE {where} AND patient_id IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NOT NULL
    AND {instant("effective_datetime")} IS NOT NULL
), firsts AS (
  SELECT patient_id, min(seen_at) AS first_at FROM kept GROUP BY patient_id
)
SELECT
  md5('patient:' || kept.patient_id) AS patient_key,
  md5('encounter:' || kept.encounter_id) AS encounter_key,
  CAST(date_diff('day', coalesce({instant("e.start_datetime")}, first_at), seen_at)
    AS BIGINT) AS event_day_index,
  kept.display AS measurement_name,
  kept.unit AS unit,
  count(*) AS measurement_count,
  min(number) AS min_value, avg(number) AS avg_value, max(number) AS max_value
FROM kept JOIN firsts ON firsts.patient_id = kept.patient_id
LEFT JOIN s_encounter e ON e.encounter_id = kept.encounter_id
GROUP BY 1, 2, 3, 4, 5
"""


def tagged_events() -> str:
    parts = []
    for table in MEDICATION_TABLES:
        activity = table.removeprefix("s_medication_")
        source = "'order'" if activity == "request" else "source_system"
        parts.append(
            f"SELECT patient_id, encounter_id, medication_code, medication_display, "
            f"'{activity}' AS activity_type, {source} AS source_system FROM {table}"
        )
    return " UNION ALL ".join(parts)


G_ACTIVITY = f"""
SELECT coalesce(m.medication_code, 'unknown') AS medication_code,
  coalesce(m.medication_display, m.medication_code, 'unknown') AS medication_display,
  m.activity_type AS activity_type, m.source_system AS source_system,
  e.class_code AS encounter_class, e.class_display AS encounter_class_display,
  count(DISTINCT m.patient_id) AS patient_count,
  count(DISTINCT m.encounter_id) AS encounter_count,
  count(*) AS event_count,
  count(m.encounter_id) AS with_encounter_context_count,
  count(*) - count(m.encounter_id) AS without_encounter_context_count
FROM ({tagged_events()}) m LEFT JOIN s_encounter e ON e.encounter_id = m.encounter_id
GROUP BY 1, 2, 3, 4, 5, 6
"""

G_FULFILLMENT = f"""
WITH a AS (
  SELECT medication_request_id, count(*) AS n, min(effective_start_datetime) AS first
  FROM s_medication_administration GROUP BY 1
), d AS (
  SELECT medication_request_id, count(*) AS n, min(when_handed_over_datetime) AS first
  FROM s_medication_dispense GROUP BY 1
)
SELECT
  md5('medication_request:' || r.medication_request_id) AS medication_request_key,
  md5('patient:' || r.patient_id) AS patient_key,
  md5('encounter:' || r.encounter_id) AS encounter_key,
  r.medication_code AS medication_code, r.medication_display AS medication_display,
  r.status AS request_status, r.intent AS request_intent,
  CAST(date_part('year', {instant("r.authored_datetime")}) AS INTEGER)
    AS authored_year,
  coalesce(a.n, 0) AS administration_count,
  coalesce(d.n, 0) AS dispense_count,
  a.first AS first_administration_datetime,
  d.first AS first_dispense_datetime,
  a.n IS NOT NULL AS has_administration,
  d.n IS NOT NULL AS has_dispense,
  CASE WHEN a.n IS NOT NULL AND d.n IS NOT NULL THEN 'administered_and_dispensed'
       WHEN a.n IS NOT NULL THEN 'administered'
       WHEN d.n IS NOT NULL THEN 'dispensed'
       ELSE 'no_linked_event' END AS fulfillment_path
FROM s_medication_request r
LEFT JOIN a ON a.medication_request_id = r.medication_request_id
LEFT JOIN d ON d.medication_request_id = r.medication_request_id
"""

G_PROCEDURE = """
SELECT p.procedure_code AS procedure_code, p.procedure_display AS procedure_display,
  p.source_system AS source_system,
  e.class_code AS encounter_class, e.class_display AS encounter_class_display,
  count(DISTINCT p.patient_id) AS patient_count,
  count(DISTINCT p.encounter_id) AS encounter_count,
  count(*) AS procedure_count,
  count(p.body_site_code) AS with_body_site_count
FROM s_procedure p LEFT JOIN s_encounter e ON e.encounter_id = p.encounter_id
GROUP BY 1, 2, 3, 4, 5
"""

TABLES = {
    **SILVER_SQL,
    "b_resources": BRONZE,
    "g_encounter_summary": G_ENCOUNTER,
    "g_condition_summary": G_CONDITION,
    "g_vitals_daily": daily(f"list_contains({VITALS}, display)"),
    "g_labs_daily": daily("category_code IN ('laboratory', 'Labs')"),
    "g_medication_activity": G_ACTIVITY,
    "g_medication_order_fulfillment": G_FULFILLMENT,
    "g_procedure_summary": G_PROCEDURE,
}

_NAME = re.compile(r"\b[sbg]_[a-z_]+\b")


def needed(sql: str) -> list[str]:
    """Layer tables a statement mentions, with those they need, in order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        for name in set(_NAME.findall(queue.pop())) & set(TABLES) - found:
            found.add(name)
            queue.append(TABLES[name])
    return [name for name in TABLES if name in found]


def with_tables(sql: str) -> str:
    """Put the definitions of all layer tables a statement needs before it."""
    parts = [f"{name} AS ({TABLES[name]})" for name in needed(sql)]
    if not parts:
        return sql
    head = "WITH " + ",\n".join(parts)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
