"""The layers as common table expressions; ``with_layers`` puts the needed ones in front of a query."""

from __future__ import annotations

import re

from stayloom.schema import (ALLOWED_VALUES, CATEGORY_REASON, DIAGNOSES, DIAGNOSIS_FAMILIES, ENCOUNTER_COLUMNS,
                             FEATURE_COLUMNS, FILL_UNKNOWN, KEY_DUPLICATE_REASON, MEDICATIONS, NUMERIC_BOUNDS,
                             REQUIRED_REASON, ROW_DUPLICATE_REASON)
from stayloom.sources.reference_data import ADMISSION_SOURCES, ADMISSION_TYPES, DISCHARGE_DISPOSITIONS

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def q(text: object) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(q(v) for v in values)


def strip(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def missing(c: str) -> str:
    return f"({c} IS NULL OR {strip(c)} IN ('', '?'))"


def half_up(part: str, whole: str, places: int, scale: int = 1) -> str:
    """Rounded half up in whole numbers, as a double."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"(CAST((2 * {scale} * {10**places} * {p} + {w}) // nullif(2 * {w}, 0) AS DOUBLE) / {10**places}.0)"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def _raw() -> str:
    def pick(value, choices, otherwise):
        return f"CASE {value} " + " ".join(
            f"WHEN {k} THEN {q(v)}" for k, v in choices.items()) + f" ELSE {q(otherwise)} END"

    states = {0: "Steady", 1: "Up", 2: "Down"}
    drugs = ",\n".join(
        (f"'No' AS {m}" if m in ("examide", "citoglipton") else f"{pick(f'(k * {i} + p) % 11', states, 'No')} AS {m}")
        for i, m in enumerate(MEDICATIONS, start=1))
    return f"""
SELECT k * 4 + copy_no AS row_id, CAST(k AS VARCHAR) AS encounter_id, CAST(p AS VARCHAR) AS patient_nbr,
  {pick('(p + k % 3) % 9', {0: '?', 1: 'AfricanAmerican', 2: 'Asian', 3: 'Hispanic', 4: 'Other'}, 'Caucasian')} AS race,
  CASE WHEN k % 997 = 5 THEN 'Unknown/Invalid' WHEN p % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN k % 1009 = 7 THEN 'invalid_age' WHEN p % 10 = 9 THEN '[90-100)'
       ELSE '[' || CAST((p % 10) * 10 AS VARCHAR) || '-' || CAST((p % 10) * 10 + 10 AS VARCHAR) || ')' END AS age,
  CASE WHEN k % 30 = 0 THEN '[75-100)' ELSE '?' END AS weight,
  CAST(k % 8 + 1 AS VARCHAR) AS admission_type_id,
  CAST((k * 7 + p) % 28 + 1 AS VARCHAR) AS discharge_disposition_id,
  CASE WHEN k % 1013 = 11 THEN 'abc' ELSE CAST((k * 5 + p) % 25 + 1 AS VARCHAR) END AS admission_source_id,
  CASE WHEN k % 1019 = 13 THEN '0' WHEN k % 1021 = 17 THEN '15'
       WHEN k % 701 = 3 THEN ' ' || CAST(k % 14 + 1 AS VARCHAR) || ' ' ELSE CAST(k % 14 + 1 AS VARCHAR) END
       AS time_in_hospital,
  {pick('k % 5', {0: 'MC', 1: 'HM', 2: ''}, '?')} AS payer_code,
  {pick('k % 4', {0: 'Cardiology', 1: 'InternalMedicine'}, '?')} AS medical_specialty,
  CASE WHEN k % 1031 = 19 THEN '-1' ELSE CAST((k * 13 + p) % 90 AS VARCHAR) END AS num_lab_procedures,
  CAST((k + p) % 7 AS VARCHAR) AS num_procedures,
  CASE WHEN k % 1033 = 23 THEN NULL ELSE CAST((k * 3 + p) % 40 + 1 AS VARCHAR) END AS num_medications,
  CASE WHEN (k + p) % 5 = 0 THEN CAST(k % 4 AS VARCHAR) ELSE '0' END AS number_outpatient,
  CASE WHEN (k + p) % 7 = 0 THEN CAST(k % 3 AS VARCHAR) ELSE '0' END AS number_emergency,
  CASE WHEN (k + p) % 3 = 0 THEN CAST(k % 5 AS VARCHAR) ELSE '0' END AS number_inpatient,
  {pick('(k * 31 + p) % 16', dict(enumerate(('250.83', '428', '486', '574', '820', '715.9', '599', '162', 'v57',
        'E909', '785.4', '786', '787', '788', '38'))), '?')} AS diag_1,
  {pick('(k * 17 + p) % 8', dict(enumerate(('250', '401', 'V45', '427.31', ' 496 ', '276', '707'))), '?')} AS diag_2,
  {pick('(k * 19 + p) % 8', dict(enumerate(('250.02', '414', 'v58', '585', '996', '272', ''))), '?')} AS diag_3,
  CASE WHEN k % 1039 = 29 THEN '17' ELSE CAST((k * 11 + p) % 16 + 1 AS VARCHAR) END AS number_diagnoses,
  {pick('k % 10', {0: 'Norm', 1: '>200', 2: '>300'}, 'None')} AS max_glu_serum,
  {pick('p % 10', {0: 'Norm', 1: '>7', 2: '>8'}, 'None')} AS a1c_result,
{drugs},
  CASE WHEN (k + p) % 2 = 0 THEN 'Ch' ELSE 'No' END AS change,
  CASE WHEN k % 4 = 0 THEN 'No' ELSE 'Yes' END AS diabetesmed,
  CASE WHEN k % 1049 = 31 THEN 'UNKNOWN' WHEN (k * 7 + p * 3) % 9 = 0 THEN '<30'
       WHEN (k * 7 + p * 3) % 9 < 4 THEN '>30' ELSE 'NO' END AS readmitted
FROM (
  SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_custkey AS BIGINT) AS p, 0 AS copy_no FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, 1 FROM orders WHERE o_orderkey % 499 = 1
  UNION ALL SELECT o_orderkey, o_custkey + 1, 2 FROM orders WHERE o_orderkey % 503 = 2)"""


def rule_selects(source: str, bounds, allowed, optional=(), key=None, columns=(), required_reason=REQUIRED_REASON,
                 category_reason=CATEGORY_REASON, key_reason=KEY_DUPLICATE_REASON,
                 row_reason=ROW_DUPLICATE_REASON, row_local_only=False) -> str:
    """One SELECT per rule, all of them united."""
    parts = []

    def add(rule, column, value, reason, condition, table=source):
        parts.append(f"SELECT row_id, {q(rule)} AS rule_name, {q(column)} AS column_name, {value} AS invalid_value, "
                     f"{q(reason)} AS rejection_reason FROM {table} WHERE {condition}")

    def shown(c):
        return f"coalesce({c}, '<NULL>')"

    for c in dict.fromkeys((*bounds, *allowed)):
        if c not in optional:
            add("required_value", c, shown(c), required_reason, missing(c))
    for c, (low, high, reason) in bounds.items():
        number = f"CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN TRY_CAST({c} AS BIGINT) END"
        bad = f"({number}) IS NULL OR ({number}) < {low}" + (f" OR ({number}) > {high}" if high is not None else "")
        add("invalid_numeric_value", c, shown(c), reason, f"NOT {missing(c)} AND ({bad})")
    for c, values in allowed.items():
        add("invalid_category", c, shown(c), category_reason,
            f"NOT {missing(c)} AND {strip(c)} NOT IN ({listed(values)})")
    if row_local_only:
        return "\nUNION ALL ".join(parts)
    if key:
        add(f"duplicate_{key}", key, key, key_reason,
            f"NOT {missing(key)} AND {key} IN (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)")
    row = ", ".join(columns)
    add("exact_duplicate_row", "*", "'<duplicate row>'", row_reason, "copies > 1",
        f"(SELECT *, count(*) OVER (PARTITION BY {row}) AS copies FROM {source})")
    return "\nUNION ALL ".join(parts)


def _curated() -> str:
    cells = []
    for c in ENCOUNTER_COLUMNS:
        text = f"CASE WHEN {strip(c)} IN ('', '?') THEN NULL ELSE {strip(c)} END"
        cells.append(f"{text} AS {c}")
    typed = []
    for c in ENCOUNTER_COLUMNS:
        if c in NUMERIC_BOUNDS:
            typed.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in FILL_UNKNOWN:
            typed.append(f"coalesce({c}, 'Unknown') AS {c}")
        elif c in DIAGNOSES:
            typed.append(f"upper({c}) AS {c}")
        else:
            typed.append(c)
    return f"""
SELECT {', '.join(typed)}, '2024-01-01 00:00:00' AS etl_processed_at, 'diabetic_data.csv' AS etl_source_file,
  '1.0.0' AS etl_version
FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY row_id) AS nth
      FROM (SELECT row_id, {', '.join(cells)} FROM valid))
WHERE nth = 1"""


def family(c: str) -> str:
    n = f"TRY_CAST(nullif(regexp_extract({c}, '^([0-9]+)', 1), '') AS DOUBLE)"
    cases = "".join(
        " WHEN " + " OR ".join(f"{n} BETWEEN {low} AND {high}" for low, high in ranges) + f" THEN {q(name)}"
        for name, ranges in DIAGNOSIS_FAMILIES)
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} LIKE '250%' THEN 'Diabetes'{cases} ELSE 'Other' END"


AGE_MIDPOINT = ("CASE WHEN age IN ('[0-10)', '[10-20)', '[20-30)', '[30-40)', '[40-50)', '[50-60)', '[60-70)', "
                "'[70-80)', '[80-90)', '[90-100)') THEN CAST(regexp_extract(age, '([0-9]+)', 1) AS INTEGER) + 5 END")


def _encounters() -> str:
    active = " + ".join(f"coalesce(CAST({m} <> 'No' AS INTEGER), 0)" for m in MEDICATIONS)
    changes = " + ".join(f"coalesce(CAST({m} IN ('Up', 'Down') AS INTEGER), 0)" for m in MEDICATIONS)
    visits = "(number_outpatient + number_emergency + number_inpatient)"
    families = ", ".join(f"{family(d)} AS {d}_group" for d in DIAGNOSES)
    return f"""
SELECT *, CAST(readmitted = '<30' AS INTEGER) AS readmitted_30_days,
  CAST(readmitted <> 'NO' AS INTEGER) AS readmitted_flag,
  {AGE_MIDPOINT} AS age_midpoint, {visits} AS total_previous_visits,
  {visits} + time_in_hospital AS healthcare_utilization_score, CAST({visits} >= 3 AS INTEGER) AS is_frequent_patient,
  {active} AS active_medications_count, {changes} AS medication_dosage_changes_count,
  CAST(insulin <> 'No' AS INTEGER) AS insulin_prescribed,
  CAST(num_medications >= 15 AS INTEGER) AS high_medication_burden_flag, {families},
  num_medications + num_procedures + number_diagnoses + time_in_hospital AS patient_complexity_score
FROM curated"""


def _values(rows) -> str:
    return ", ".join(f"({number}, {q(text.strip().strip(chr(34)))})" for number, text in rows)


def _explored() -> str:
    cells = ", ".join(f"CASE WHEN {c} IN ('?', '') THEN NULL ELSE {c} END AS {c}" for c in ENCOUNTER_COLUMNS)
    visits = " + ".join(f"coalesce(TRY_CAST({c} AS BIGINT), 0)" for c in (
        "number_outpatient", "number_emergency", "number_inpatient"))
    return f"""
SELECT *, CAST(readmitted = '<30' AS INTEGER) AS readmitted_30_days, {visits} AS total_previous_visits,
  CAST(insulin <> 'No' AS INTEGER) AS insulin_prescribed, {family('diag_1')} AS diag_1_group
FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY row_id) AS nth
      FROM (SELECT row_id, {cells} FROM raw))
WHERE nth = 1"""


_UNPIVOT = " UNION ALL ".join(
    f"SELECT encounter_id AS encounter_key, {q(m)} AS medication_name, {m} AS status FROM curated WHERE {m} <> 'No'"
    for m in MEDICATIONS)

CTES = {
    "raw": _raw(),
    "violations": rule_selects("raw", NUMERIC_BOUNDS, ALLOWED_VALUES, ("race",), "encounter_id", ENCOUNTER_COLUMNS),
    "valid": "SELECT * FROM raw WHERE row_id NOT IN (SELECT row_id FROM violations)",
    "curated": _curated(),
    "encounters": _encounters(),
    "features": f"SELECT {', '.join(FEATURE_COLUMNS)} FROM encounters",
    "blanked": "SELECT row_id, " + ", ".join(
        f"CASE WHEN {c} IN ('?', '') THEN NULL ELSE {c} END AS {c}" for c in ENCOUNTER_COLUMNS) + " FROM raw",
    "explored": _explored(),
    "dim_patient": """
SELECT row_number() OVER (ORDER BY patient_nbr) AS patient_key, patient_nbr, gender, race, age AS first_age_bracket,
  age_midpoint AS first_age_midpoint
FROM (SELECT *, row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) AS nth FROM encounters)
WHERE nth = 1""",
    "dim_diagnosis": f"""
SELECT row_number() OVER (ORDER BY diagnosis_code) AS diagnosis_key, diagnosis_code,
  {family('diagnosis_code')} AS diagnosis_group
FROM (SELECT diag_1 AS diagnosis_code FROM curated WHERE diag_1 IS NOT NULL
      UNION SELECT diag_2 FROM curated WHERE diag_2 IS NOT NULL
      UNION SELECT diag_3 FROM curated WHERE diag_3 IS NOT NULL)""",
    "dim_medication": f"""
SELECT CAST(row_number() OVER (ORDER BY medication_name) AS INTEGER) AS medication_key, medication_name
FROM (VALUES {', '.join(f"({q(m)})" for m in MEDICATIONS)}) AS t(medication_name)""",
    "dim_admission_type":
        f"SELECT * FROM (VALUES {_values(ADMISSION_TYPES)}) AS t(admission_type_id, admission_type_description)",
    "dim_discharge_disposition": f"SELECT * FROM (VALUES {_values(DISCHARGE_DISPOSITIONS)}) "
                                 "AS t(discharge_disposition_id, discharge_disposition_description)",
    "dim_admission_source": f"SELECT * FROM (VALUES {_values(ADMISSION_SOURCES)}) "
                            "AS t(admission_source_id, admission_source_description)",
    "fact_hospitalization": f"""
SELECT c.encounter_id AS encounter_key, p.patient_key, CAST(c.admission_type_id AS INTEGER) AS admission_type_id,
  CAST(c.discharge_disposition_id AS INTEGER) AS discharge_disposition_id,
  CAST(c.admission_source_id AS INTEGER) AS admission_source_id,
  d1.diagnosis_key AS diag_1_key, d2.diagnosis_key AS diag_2_key, d3.diagnosis_key AS diag_3_key,
  {', '.join(f"CAST(c.{c} AS INTEGER) AS {c}" for c in ("time_in_hospital", "num_lab_procedures", "num_procedures",
                                                     "num_medications", "number_diagnoses"))},
  {', '.join(f"CAST(f.{c} AS INTEGER) AS {c}" for c in ("total_previous_visits", "healthcare_utilization_score",
                                                     "patient_complexity_score"))}
FROM curated c JOIN features f ON f.encounter_id = c.encounter_id
JOIN dim_patient p ON p.patient_nbr = c.patient_nbr
LEFT JOIN dim_diagnosis d1 ON d1.diagnosis_code = c.diag_1
LEFT JOIN dim_diagnosis d2 ON d2.diagnosis_code = c.diag_2
LEFT JOIN dim_diagnosis d3 ON d3.diagnosis_code = c.diag_3""",
    "fact_readmission": """
SELECT encounter_id AS encounter_key, readmitted, readmitted_30_days, readmitted_flag, is_frequent_patient,
  insulin_prescribed, high_medication_burden_flag FROM encounters""",
    "fact_medication_usage": f"""
SELECT row_number() OVER (ORDER BY encounter_key, medication_key) AS fact_medication_usage_id, encounter_key,
  medication_key, status, CASE WHEN status IN ('Up', 'Down') THEN 1 ELSE 0 END AS dosage_changed
FROM ({_UNPIVOT}) u JOIN dim_medication USING (medication_name)""",
    "mart_patients": """
SELECT p.patient_key, p.patient_nbr, p.gender, p.race, p.first_age_bracket, p.first_age_midpoint,
  count(h.encounter_key) AS total_encounters,
  CAST(sum(h.total_previous_visits) AS BIGINT) AS total_previous_visits_sum,
  max(r.is_frequent_patient) AS is_frequent_patient_ever,
  CAST(sum(r.readmitted_30_days) AS BIGINT) AS readmitted_30_days_count,
  CAST(sum(r.readmitted_flag) AS BIGINT) AS readmitted_count
FROM dim_patient p JOIN fact_hospitalization h ON h.patient_key = p.patient_key
JOIN fact_readmission r ON r.encounter_key = h.encounter_key
GROUP BY ALL""",
    "mart_hospitalizations": """
SELECT h.encounter_key, h.patient_key, p.gender, p.race, p.first_age_bracket, t.admission_type_description,
  d.discharge_disposition_description, s.admission_source_description, h.time_in_hospital, h.num_lab_procedures,
  h.num_procedures, h.num_medications, h.number_diagnoses, h.total_previous_visits, h.healthcare_utilization_score,
  h.patient_complexity_score
FROM fact_hospitalization h JOIN dim_patient p ON p.patient_key = h.patient_key
LEFT JOIN dim_admission_type t ON t.admission_type_id = h.admission_type_id
LEFT JOIN dim_discharge_disposition d ON d.discharge_disposition_id = h.discharge_disposition_id
LEFT JOIN dim_admission_source s ON s.admission_source_id = h.admission_source_id""",
    "mart_readmission": """
SELECT h.encounter_key, p.gender, p.race, p.first_age_bracket, t.admission_type_description,
  d.diagnosis_group AS diag_1_group, h.time_in_hospital, h.total_previous_visits, r.readmitted, r.readmitted_30_days,
  r.readmitted_flag, r.is_frequent_patient, r.insulin_prescribed, r.high_medication_burden_flag
FROM fact_hospitalization h JOIN fact_readmission r ON r.encounter_key = h.encounter_key
JOIN dim_patient p ON p.patient_key = h.patient_key
LEFT JOIN dim_admission_type t ON t.admission_type_id = h.admission_type_id
LEFT JOIN dim_diagnosis d ON d.diagnosis_key = h.diag_1_key""",
    "mart_diagnostics": f"""
SELECT d.diagnosis_code, d.diagnosis_group, count(h.encounter_key) AS hospitalization_count,
  count(DISTINCT h.patient_key) AS patient_count,
  {half_up('sum(r.readmitted_30_days)', 'count(r.readmitted_30_days)', 4)} AS readmitted_30_days_rate,
  {half_up('sum(h.time_in_hospital)', 'count(h.time_in_hospital)', 2)} AS avg_time_in_hospital
FROM fact_hospitalization h JOIN fact_readmission r ON r.encounter_key = h.encounter_key
JOIN dim_diagnosis d ON d.diagnosis_key = h.diag_1_key
GROUP BY d.diagnosis_code, d.diagnosis_group""",
    "mart_medications": f"""
SELECT m.medication_name, count(*) AS prescription_count, CAST(sum(u.dosage_changed) AS BIGINT) AS dosage_change_count,
  count(DISTINCT u.encounter_key) AS hospitalization_count,
  {half_up('sum(r.readmitted_30_days)', 'count(r.readmitted_30_days)', 4)} AS readmitted_30_days_rate
FROM fact_medication_usage u JOIN dim_medication m ON m.medication_key = u.medication_key
JOIN fact_readmission r ON r.encounter_key = u.encounter_key
GROUP BY m.medication_name""",
    "quality_runs": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS raw_file_name, min(ts) AS started_at, max(ts) AS finished_at,
  count(*) AS total_rows, CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS BIGINT) AS valid_rows,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows
FROM events GROUP BY CAST(ts AS DATE)""",
    "mart_quality": f"""
SELECT raw_file_name, total_rows, valid_rows, rejected_rows,
  CASE WHEN total_rows > 0 THEN {half_up('valid_rows', 'total_rows', 4, 100)} END AS valid_rate_percent,
  started_at, finished_at FROM quality_runs""",
    "etl_runs": """
SELECT CAST(event_id AS BIGINT) AS id,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
  'table_' || CAST(user_id % 5 AS VARCHAR) AS target_table, ts AS started_at,
  CASE WHEN event_type <> 'signup' THEN ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) END AS finished_at,
  event_id % 1000 + 10 AS input_rows,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE event_id % 1000 + 10 - event_id % 7 END AS output_rows,
  CASE WHEN event_type = 'error' THEN props END AS error_message
FROM events""",
    "file_ledger": """
SELECT CAST(d.doc_id AS BIGINT) AS id, d.source AS source_file_name, sha256(d.text) AS sha256,
  CAST(length(d.text) AS BIGINT) AS file_size_chars,
  CASE l.quality WHEN 1 THEN 'SUCCESS' WHEN 0 THEN 'FAILED' ELSE 'NEW' END AS status
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "scored": """
SELECT d.doc_id, CAST(l.quality AS INT) AS y_true, CASE WHEN d.n_chars * 37 % 1000 >= 500 THEN 1 ELSE 0 END AS y_pred,
  CAST(d.n_chars * 37 % 1000 AS DOUBLE) / 1000 AS score
FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
    "thresholds": "SELECT quantile_cont(score, 0.80) AS medium_threshold, quantile_cont(score, 0.95) AS high_threshold "
                  "FROM scored",
    "banded": """
SELECT s.*, CASE WHEN score < (SELECT medium_threshold FROM thresholds) THEN 'Low'
  WHEN score < (SELECT high_threshold FROM thresholds) THEN 'Medium' ELSE 'High' END AS predicted_risk_category
FROM scored s""",
    "model_rows": """
SELECT encounter_id, time_in_hospital, num_lab_procedures, num_procedures, num_medications, number_diagnoses,
  age_midpoint, total_previous_visits, healthcare_utilization_score, patient_complexity_score,
  active_medications_count, medication_dosage_changes_count, coalesce(gender, 'None') AS gender,
  coalesce(race, 'None') AS race, coalesce(CAST(admission_type_id AS VARCHAR), 'None') AS admission_type_id,
  coalesce(CAST(discharge_disposition_id AS VARCHAR), 'None') AS discharge_disposition_id,
  coalesce(CAST(admission_source_id AS VARCHAR), 'None') AS admission_source_id,
  coalesce(max_glu_serum, 'None') AS max_glu_serum, coalesce(a1c_result, 'None') AS a1c_result,
  coalesce(change, 'None') AS change, coalesce(diabetesmed, 'None') AS diabetesmed,
  coalesce(CAST(insulin_prescribed AS VARCHAR), 'None') AS insulin_prescribed,
  coalesce(diag_1_group, 'None') AS diag_1_group, readmitted_30_days
FROM encounters WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""",
    "outcomes": "SELECT h.*, r.* EXCLUDE (encounter_key) FROM fact_hospitalization h "
                "JOIN fact_readmission r ON r.encounter_key = h.encounter_key",
}


def with_layers(sql: str) -> str:
    """Prefix a query with the layers it names, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed) + "\n" + sql) if needed else sql
