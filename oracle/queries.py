"""One SQL statement per named query."""

from __future__ import annotations

from stayloom.schema import (ALLOWED_VALUES, DIAGNOSES, ENCOUNTER_COLUMNS, FEATURE_COLUMNS, FLAG_COLUMNS, MEDICATIONS,
                             MODEL_NUMERIC, NUMERIC_BOUNDS)

from .ctes import big, family, half_up, listed, missing, q, rule_selects, strip, with_layers

VISITS = ("number_outpatient", "number_emergency", "number_inpatient")
NUMBERS = ("time_in_hospital", "num_medications", "number_diagnoses", "num_lab_procedures", "num_procedures", *VISITS)
MAIN_NUMBERS = ("time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", *VISITS,
                "number_diagnoses")
SQL: dict[str, str] = {}


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def long(source: str, columns) -> str:
    return union(f"SELECT {q(c)} AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns)


NUMBER_ROWS = "SELECT row_id, " + ", ".join(f"TRY_CAST({c} AS BIGINT) AS {c}" for c in NUMBERS) + " FROM raw"

# --- raw rows ---
SQL["raw_encounters"] = "SELECT * FROM raw"
SQL["missing_flags"] = "SELECT row_id, " + ", ".join(
    f"CAST({missing(c)} AS INTEGER) AS {c}_missing" for c in ENCOUNTER_COLUMNS) + " FROM raw"
SQL["null_tokens"] = "SELECT row_id, " + ", ".join(
    f"CASE WHEN {c} NOT IN ('?', 'Unknown/Invalid', 'NULL', 'None', '') THEN {c} END AS {c}"
    for c in ENCOUNTER_COLUMNS) + " FROM raw"
SQL["preview_head"] = "SELECT * FROM raw ORDER BY row_id LIMIT 10"
SQL["preview_tail"] = "SELECT * FROM raw ORDER BY row_id DESC LIMIT 5"
SQL["anomaly_counts"] = f"WITH n AS ({NUMBER_ROWS}) " + union([
    "SELECT 'time_in_hospital_not_positive' AS column_name, count(*) AS invalid_count FROM n "
    "WHERE time_in_hospital <= 0 OR time_in_hospital IS NULL",
    *(f"SELECT '{c}_negative', count(*) FROM n WHERE {c} < 0" for c in (
        "num_medications", "number_diagnoses", "num_lab_procedures", *VISITS))])
SQL["anomaly_rows"] = (f"SELECT * FROM ({NUMBER_ROWS}) WHERE time_in_hospital IS NULL OR time_in_hospital <= 0 "
                       "OR num_medications IS NULL OR num_medications <= 0 OR num_lab_procedures < 0")
SQL["own_specialty_rows"] = ("SELECT encounter_id, patient_nbr, medical_specialty FROM curated "
                             "WHERE medical_specialty = 'Cardiology'")
SQL["granted_specialty_rows"] = """
SELECT encounter_id, patient_nbr, medical_specialty FROM curated WHERE medical_specialty IN (
  SELECT CASE c_custkey % 3 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'InternalMedicine' ELSE 'Unknown' END
  FROM customer WHERE c_name = 'Customer#000000002')"""

# --- data quality ---
WHOLE = ", ".join(f"r.{c}" for c in ENCOUNTER_COLUMNS)
SQL["dq_violations"] = "SELECT * FROM violations"
SQL["dq_valid_rows"] = "SELECT * FROM valid"
SQL["dq_valid_by_anti_join"] = "SELECT row_id, encounter_id, patient_nbr FROM valid"
SQL["dq_quarantine"] = f"SELECT v.*, {WHOLE} FROM violations v LEFT JOIN raw r ON r.row_id = v.row_id"
SQL["dq_quarantine_by_join"] = SQL["dq_quarantine"]
SQL["dq_key_duplicates"] = "SELECT * FROM violations WHERE rule_name = 'duplicate_encounter_id'"
SQL["dq_row_duplicates"] = "SELECT * FROM violations WHERE rule_name = 'exact_duplicate_row'"
SQL["dq_rule_summary"] = ("SELECT rule_name, column_name, rejection_reason, count(*) AS violation_count "
                          "FROM violations GROUP BY ALL")
MISSING_SUMMARY = union(
    f"SELECT {q(c)} AS column_name, count(*) FILTER ({missing(c)}) AS missing_count, "
    f"coalesce({half_up(f'count(*) FILTER ({missing(c)})', 'count(*)', 4, 100)}, 0.0) AS missing_rate_percent FROM raw"
    for c in ENCOUNTER_COLUMNS)
SQL["dq_missing_summary"] = MISSING_SUMMARY
RUN_TOTALS = f"""
SELECT total_rows, total_rows - rejected_rows AS valid_rows, rejected_rows, total_violations, duplicate_rows,
  {half_up('total_rows - rejected_rows', 'total_rows', 4, 100)} AS valid_rate_percent
FROM (SELECT (SELECT count(*) FROM raw) AS total_rows, count(DISTINCT row_id) AS rejected_rows,
        count(*) AS total_violations,
        count(DISTINCT CASE WHEN rule_name = 'exact_duplicate_row' THEN row_id END) AS duplicate_rows
      FROM violations)"""
SQL["dq_run_totals"] = RUN_TOTALS
SQL["dq_lineitem"] = """WITH t AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
  CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, l_linestatus
  FROM lineitem) """ + rule_selects(
    "t", {"l_orderkey": (1, None, "order key must be positive"), "l_linenumber": (1, 3, "line must be 1 to 3"),
          "l_suppkey": (2, None, "supplier must be 2 or more")},
    {"l_returnflag": ("A", "N"), "l_linestatus": ("O", "F")},
    columns=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"))
SQL["dq_customer"] = """WITH t AS (SELECT c_custkey AS row_id, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  c_mktsegment FROM customer) """ + rule_selects(
    "t", {"c_nationkey": (0, 20, "nation must be 0 to 20")},
    {"c_mktsegment": ("BUILDING", "AUTOMOBILE", "MACHINERY")}, key="c_name",
    columns=("c_name", "c_nationkey", "c_mktsegment"))
SQL["dq_events_summary"] = """WITH t AS (SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
  CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value FROM events), v AS (""" + rule_selects(
    "t", {"user_id": (1, None, "user must be positive")}, {"event_type": ("click", "view", "signup", "purchase")},
    optional=("event_type",), columns=("user_id", "event_type", "value")) + """)
SELECT rule_name, column_name, rejection_reason, count(*) AS violation_count FROM v GROUP BY ALL"""

# --- clean ---
SQL["clean_curated"] = "SELECT * FROM curated"


def nulls(columns, source):
    cells = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)
    return f"(SELECT CAST(coalesce(sum({cells}), 0) AS BIGINT) FROM {source})"


AUDIT = ("etl_processed_at", "etl_source_file", "etl_version")
SQL["clean_stats"] = f"""SELECT i AS input_rows, o AS output_rows, i - o AS duplicates_removed,
  50 AS source_columns, 53 AS output_columns, {nulls(ENCOUNTER_COLUMNS, 'valid')} AS null_values_before,
  {nulls((*ENCOUNTER_COLUMNS, *AUDIT), 'curated')} AS null_values_after
FROM (SELECT (SELECT count(*) FROM valid) AS i, (SELECT count(*) FROM curated) AS o)"""
TEXTS = [c for c in ENCOUNTER_COLUMNS if c not in NUMERIC_BOUNDS] + ["etl_source_file", "etl_version"]


def unique_checks(source, key):
    return [f"SELECT 'key_not_null' AS check_name, count(*) - count({key}) AS failed_rows FROM {source}",
            f"SELECT 'key_unique' AS check_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS failed_rows "
            f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"]


SQL["clean_checks"] = union([
    "SELECT 'not_empty' AS check_name, CAST(count(*) = 0 AS BIGINT) AS failed_rows FROM curated",
    *(f"SELECT 'bigint_{c}', count(*) FILTER (typeof({c}) <> 'BIGINT') FROM curated" for c in NUMERIC_BOUNDS),
    *(f"SELECT 'no_question_mark_{c}', count(*) FILTER ({strip(c)} = '?') FROM curated" for c in TEXTS),
    *unique_checks("curated", "encounter_id")])
SQL["dedup_keep_first"] = f"""
SELECT row_id, key AS encounter_id, patient_nbr, gender
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY row_id) AS nth FROM (
  SELECT *, CASE WHEN {strip('encounter_id')} NOT IN ('', '?') THEN {strip('encounter_id')} END AS key FROM raw))
WHERE nth = 1"""
SQL["stored_reconciliation"] = """
SELECT (SELECT count(*) FROM valid) AS input_rows, count(*) AS stored_rows,
  count(DISTINCT encounter_id) AS distinct_keys,
  count(*) = count(DISTINCT encounter_id) AND count(*) = (SELECT count(*) FROM valid) AS reconciled FROM curated"""

# --- features ---
SQL["feature_table"] = "SELECT * FROM features"


def four(c):
    return f"coalesce({half_up(f'sum({c})', f'count({c})', 4)}, 0.0)"


SQL["feature_stats"] = f"""SELECT (SELECT count(*) FROM curated) AS input_rows, count(*) AS output_rows,
  {len(FEATURE_COLUMNS)} AS output_columns, {four('readmitted_30_days')} AS readmitted_30_days_rate,
  {four('is_frequent_patient')} AS frequent_patient_rate, {four('insulin_prescribed')} AS insulin_prescribed_rate
FROM features"""
SQL["feature_checks"] = union([
    "SELECT 'not_empty' AS check_name, CAST(count(*) = 0 AS BIGINT) AS failed_rows FROM features",
    *unique_checks("features", "encounter_id"),
    *(f"SELECT 'domain_{c}', count(*) FILTER ({c} NOT IN (0, 1)) FROM features" for c in FLAG_COLUMNS)])
SQL["diagnosis_family"] = (
    f"SELECT code, count(*) AS uses, {family('code')} AS family FROM ("
    + union(f"SELECT {d} AS code FROM curated" for d in DIAGNOSES) + ") WHERE code IS NOT NULL GROUP BY code")
SQL["curated_with_features"] = """
SELECT c.encounter_id, c.patient_nbr, c.age, f.age_midpoint, c.readmitted, f.readmitted_30_days, c.diag_1,
  f.diag_1_group, f.total_previous_visits
FROM curated c JOIN features f ON f.encounter_id = c.encounter_id"""

# --- star schema ---
for name in ("dim_patient", "dim_diagnosis", "fact_hospitalization", "fact_readmission", "fact_medication_usage",
             "mart_patients", "mart_hospitalizations", "mart_readmission", "mart_diagnostics", "mart_medications"):
    SQL[name] = f"SELECT * FROM {name}"
SQL["foreign_key_checks"] = union(
    f"SELECT {q(label)} AS check_name, count(*) AS failed_rows FROM {child} "
    f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
    for label, child, column, parent, key in (
        ("bridge_encounter_key", "fact_medication_usage", "encounter_key", "fact_hospitalization", "encounter_key"),
        ("fk_patient_key", "fact_hospitalization", "patient_key", "dim_patient", "patient_key"),
        *((f"fk_{d}_key", "fact_hospitalization", f"{d}_key", "dim_diagnosis", "diagnosis_key") for d in DIAGNOSES),
        *((f"fk_{c}_id", "fact_hospitalization", f"{c}_id", f"dim_{c}", f"{c}_id") for c in (
            "admission_type", "discharge_disposition", "admission_source")),
        ("fk_encounter_key", "fact_readmission", "encounter_key", "fact_hospitalization", "encounter_key"),
        ("fk_medication_key", "fact_medication_usage", "medication_key", "dim_medication", "medication_key")))
SQL["unique_key_checks"] = union(
    f"SELECT {q(t)} AS table_name, check_name, failed_rows FROM ({part})"
    for t, key in (("dim_patient", "patient_nbr"), ("dim_diagnosis", "diagnosis_code"),
                   ("fact_hospitalization", "encounter_key"), ("fact_readmission", "encounter_key"),
                   ("fact_medication_usage", "fact_medication_usage_id"))
    for part in unique_checks(t, key))
SQL["star_counts"] = union([
    *(f"SELECT {q(t)} AS table_name, count(*) AS row_count FROM {t}" for t in (
        "dim_admission_type", "dim_discharge_disposition", "dim_admission_source", "dim_patient", "dim_diagnosis",
        "dim_medication", "fact_hospitalization", "fact_readmission", "fact_medication_usage")),
    "SELECT 'dim_date', count(*) FROM generate_series(DATE '1999-01-01', DATE '2008-12-31', INTERVAL 1 DAY)"])
SQL["absent_patients"] = ("SELECT c_custkey AS patient_nbr, c_name FROM customer "
                          "WHERE c_custkey NOT IN (SELECT patient_nbr FROM dim_patient)")
SQL["stacked_sections"] = """
WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS file,
    (CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey) * 100000 + l_suppkey AS line_no,
    CASE WHEN l_linenumber = 1 AND l_orderkey % 5 <> 0 THEN 'head' WHEN l_linenumber = 4 AND l_orderkey % 4 = 0
      THEN 'blank' WHEN l_partkey % 7 = 0 THEN 'text' ELSE 'data' END AS kind,
    CASE l_orderkey % 3 WHEN 0 THEN 'admission_type_id' WHEN 1 THEN 'discharge_disposition_id'
      ELSE 'admission_source_id' END AS header,
    CAST(l_partkey AS INTEGER) AS id, CASE WHEN l_partkey % 11 = 0 THEN 'Non disponible' ELSE l_returnflag END
      AS description
  FROM lineitem),
marks AS (
  SELECT l.*, (SELECT max(m.line_no) FROM lines m WHERE m.file = l.file AND m.kind IN ('head', 'blank')
               AND m.line_no <= l.line_no) AS last_mark FROM lines l)
SELECT d.file, d.line_no, d.header AS section, d.id, d.description
FROM marks d JOIN lines h ON h.file = d.file AND h.line_no = d.last_mark AND h.kind = 'head'
WHERE d.kind = 'data'"""
SQL["reference_code_usage"] = union(
    f"SELECT 'dim_{c}' AS dimension, d.{c}_id AS code, d.{c}_description AS description, "
    f"count(h.encounter_key) AS encounters FROM dim_{c} d LEFT JOIN fact_hospitalization h ON h.{c}_id = d.{c}_id "
    "GROUP BY ALL" for c in ("admission_type", "discharge_disposition", "admission_source"))
DAYS = """
SELECT CAST(d AS DATE) AS full_date, isodow(d) >= 6 AS is_weekend,
  (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(d AS DATE)) AS orders
FROM generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
  (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY) AS g(d)"""
SQL["calendar_days"] = f"""
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(full_date AS VARCHAR) AS full_date,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(month(full_date) AS INTEGER) AS month_number,
  monthname(full_date) AS month_name, CAST(quarter(full_date) AS INTEGER) AS quarter_number,
  CAST(year(full_date) AS INTEGER) AS year_number, CAST(isodow(full_date) AS INTEGER) AS day_of_week_number,
  dayname(full_date) AS day_name, is_weekend, orders FROM ({DAYS})"""
SQL["calendar_drill"] = f"""
SELECT CAST(year(full_date) AS INTEGER) AS year_number, CAST(quarter(full_date) AS INTEGER) AS quarter_number,
  CAST(month(full_date) AS INTEGER) AS month_number, count(*) AS days, count(*) FILTER (is_weekend) AS weekend_days,
  CAST(sum(orders) AS BIGINT) AS orders, CAST(grouping_id(year(full_date), quarter(full_date), month(full_date)) AS INTEGER) AS level
FROM ({DAYS}) GROUP BY ROLLUP (year(full_date), quarter(full_date), month(full_date))"""

# --- marts and KPIs ---
SQL["mart_quality"] = ("SELECT raw_file_name, total_rows, valid_rows, rejected_rows, valid_rate_percent, "
                       f"{stamp('started_at')}, {stamp('finished_at')} FROM mart_quality")
SQL["mart_quality_violations"] = ("SELECT 1 AS quality_run_id, rule_name, column_name, count(*) AS violation_count, "
                                  "rejection_reason AS description FROM violations GROUP BY ALL")
SQL["mart_counts"] = union(f"SELECT {q(t)} AS table_name, count(*) AS row_count FROM {t}" for t in (
    "mart_patients", "mart_hospitalizations", "mart_readmission", "mart_diagnostics", "mart_medications",
    "dim_patient", "fact_hospitalization"))
SQL["kpi_global"] = """
SELECT count(encounter_key) AS total_hospitalizations, count(DISTINCT patient_key) AS total_patients,
  CAST(coalesce(sum(readmitted_flag), 0) AS BIGINT) AS total_readmissions,
  coalesce(avg(readmitted_flag), 0) AS readmission_rate,
  coalesce(avg(readmitted_30_days), 0) AS readmitted_30_days_rate,
  coalesce(avg(time_in_hospital), 0) AS avg_time_in_hospital,
  coalesce(avg(num_medications), 0) AS avg_num_medications,
  coalesce(avg(number_diagnoses), 0) AS avg_number_diagnoses FROM outcomes"""
SQL["kpi_activity"] = f"""
SELECT count(*) AS encounters, count(DISTINCT patient_key) AS patients, {big('sum(readmitted_flag)')} AS readmissions,
  {big('sum(readmitted_30_days)')} AS readmissions_30_days,
  count(*) / count(DISTINCT patient_key) AS encounters_per_patient,
  count(DISTINCT CASE WHEN is_frequent_patient = 1 THEN patient_key END) AS frequent_patients FROM outcomes"""
SQL["kpi_averages"] = """
SELECT sum(readmitted_flag) / count(*) AS readmission_rate, sum(readmitted_30_days) / count(*) AS readmitted_30_days_rate,
  avg(readmitted_flag) - avg(readmitted_30_days) AS readmitted_after_30_days_rate,
  avg(insulin_prescribed) AS insulin_rate, avg(time_in_hospital) AS avg_time_in_hospital,
  avg(total_previous_visits) AS avg_previous_visits, avg(num_procedures) AS avg_num_procedures,
  avg(num_lab_procedures) AS avg_num_lab_procedures, avg(num_medications) AS avg_num_medications,
  avg(number_diagnoses) AS avg_number_diagnoses FROM outcomes"""


def factor(column):
    return (f"SELECT {q(column)} AS factor, {column} AS value, count(*) AS encounters, "
            f"sum(readmitted_30_days) / count(*) AS readmitted_30_days_rate FROM mart_readmission GROUP BY {column}")


SQL["kpi_by_factor"] = union(map(factor, ("first_age_bracket", "gender", "race")))
SQL["readmission_by_family"] = union(map(factor, ("diag_1_group", "admission_type_description")))
SQL["kpi_patients_by_group"] = ("SELECT gender, first_age_bracket, race, count(DISTINCT patient_key) AS patients "
                                "FROM mart_hospitalizations GROUP BY ALL")


def ranking(role, level="diagnosis_group"):
    return (f"SELECT d.{level}, count(*) AS encounters, sum(readmitted_30_days) / count(*) AS readmitted_30_days_rate "
            f"FROM outcomes o LEFT JOIN dim_diagnosis d ON d.diagnosis_key = o.{role}_key GROUP BY d.{level}")


SQL["kpi_top_diagnoses"] = ranking("diag_1")
SQL["kpi_top_codes"] = (f"SELECT * FROM ({ranking('diag_1', 'diagnosis_code')}) WHERE diagnosis_code IS NOT NULL "
                        "ORDER BY encounters DESC, diagnosis_code")
SQL["kpi_by_role"] = union(f"SELECT {q(d)} AS role, * FROM ({ranking(d)})" for d in DIAGNOSES)
SQL["kpi_switched_measure"] = union(
    f"SELECT {q(name)} AS measure, first_age_bracket, sum({c}) / count(*) AS value FROM mart_readmission "
    "GROUP BY first_age_bracket" for name, c in (
        ("readmission_rate", "readmitted_flag"), ("readmitted_30_days_rate", "readmitted_30_days")))
SQL["kpi_top_drugs"] = "SELECT * FROM mart_medications ORDER BY prescription_count DESC, medication_name"
SQL["kpi_drug_changes"] = ("SELECT medication_name, dosage_change_count, "
                           f"{half_up('dosage_change_count', 'prescription_count', 2, 100)} AS change_percent "
                           "FROM mart_medications")


def categories(source, columns):
    return (f"SELECT column_name, value, count(*) AS count, "
            f"{half_up('count(*)', f'(SELECT count(*) FROM {source})', 2, 100)} AS percentage "
            f"FROM ({long(source, columns)}) GROUP BY column_name, value")


SQL["kpi_encounters_by_admission"] = categories("mart_hospitalizations", (
    "admission_type_description", "admission_source_description", "discharge_disposition_description"))
SQL["kpi_stay_by_complexity"] = ("SELECT time_in_hospital, patient_complexity_score, count(*) AS encounters "
                                 "FROM mart_hospitalizations GROUP BY ALL")
SQL["patients_page"] = """
SELECT *, count(*) OVER () AS total FROM mart_patients WHERE gender = 'Female' AND race = 'Caucasian'
ORDER BY patient_key LIMIT 50 OFFSET 20"""
SQL["hospitalizations_page"] = ("SELECT *, count(*) OVER () AS total FROM mart_hospitalizations "
                                "ORDER BY encounter_key LIMIT 50 OFFSET 100")
SQL["readmissions_page"] = ("SELECT *, count(*) OVER () AS total FROM mart_readmission WHERE readmitted_30_days = 1 "
                            "ORDER BY encounter_key LIMIT 25")
SQL["encounter_detail"] = "SELECT * FROM mart_readmission WHERE encounter_key = 1234"
SQL["patient_detail"] = "SELECT * FROM mart_patients WHERE patient_nbr = 77"

# --- run histories and ledgers ---
SQL["quality_run_list"] = ("SELECT raw_file_name, total_rows, valid_rows, rejected_rows, valid_rate_percent, "
                           "strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, "
                           "strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at FROM (SELECT * FROM mart_quality "
                           "ORDER BY started_at DESC, raw_file_name DESC LIMIT 20)")
SQL["etl_run_list"] = ("SELECT id AS run_id, status, target_table, input_rows, output_rows, "
                       f"{stamp('started_at')}, {stamp('finished_at')}, replace(error_message, '|', '/') AS "
                       "error_message FROM (SELECT * FROM etl_runs ORDER BY started_at DESC, id DESC LIMIT 50)")
SQL["etl_run_kpis"] = """
SELECT count(id) AS runs, avg(CAST(trunc(epoch_us(finished_at) / 1e6 - epoch_us(started_at) / 1e6 + 0.0000001) AS BIGINT))
    AS avg_duration_seconds,
  strftime(max(started_at), '%Y-%m-%d %H:%M:%S') AS last_started_at,
  (SELECT status FROM etl_runs ORDER BY started_at DESC, id DESC LIMIT 1) AS last_status,
  count(*) FILTER (status = 'FAILED') AS failed_runs,
  CAST(trunc((epoch_us(TIMESTAMP '2025-01-01') - epoch_us(max(finished_at))) / 1e6) AS BIGINT) AS freshness_seconds
FROM etl_runs"""
SQL["quality_kpis"] = f"""
SELECT {big('sum(total_rows)')} AS rows_imported, {big('sum(valid_rows)')} AS rows_valid,
  {big('sum(rejected_rows)')} AS rows_rejected, {half_up('sum(valid_rows)', 'sum(total_rows)', 4, 100)} AS score
FROM mart_quality"""
SQL["quality_latest"] = ("SELECT raw_file_name, total_rows, valid_rows, rejected_rows, valid_rate_percent "
                         "FROM mart_quality ORDER BY started_at DESC, raw_file_name DESC LIMIT 1")
SQL["quality_trend"] = """
SELECT raw_file_name, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, rejected_rows, valid_rate_percent,
  lag(rejected_rows) OVER w AS previous_rejected_rows, rejected_rows - lag(rejected_rows) OVER w AS rejected_rows_change
FROM mart_quality WINDOW w AS (ORDER BY started_at, raw_file_name)"""
SQL["etl_trend"] = """
SELECT id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, output_rows,
  lag(output_rows) OVER w AS previous_output_rows, output_rows - lag(output_rows) OVER w AS output_rows_change
FROM etl_runs WHERE output_rows IS NOT NULL WINDOW w AS (ORDER BY started_at, id)"""
SQL["run_current_state"] = (f"SELECT id AS run_id, status, {stamp('started_at')}, {stamp('finished_at')}, "
                            "output_rows, error_message FROM etl_runs")
SQL["file_fingerprints"] = "SELECT * FROM file_ledger"
SQL["import_decisions"] = """
SELECT id, source_file_name, sha256, previous AS previous_import_id,
  CASE WHEN previous IS NULL THEN 'IMPORT' ELSE 'SKIPPED' END AS decision
FROM (SELECT f.*, coalesce((SELECT max(s.id) FROM file_ledger s WHERE s.status = 'SUCCESS' AND s.sha256 = f.sha256),
        CASE WHEN id > min(id) OVER (PARTITION BY sha256) THEN min(id) OVER (PARTITION BY sha256) END) AS previous
      FROM file_ledger f WHERE status = 'NEW')"""
SQL["import_new_only"] = ("SELECT min(id) AS id, sha256 FROM file_ledger WHERE status = 'NEW' AND sha256 NOT IN "
                          "(SELECT sha256 FROM file_ledger WHERE status = 'SUCCESS') GROUP BY sha256")
SQL["import_admission"] = """
SELECT page_id, url, size, CASE WHEN page_id % 2 = 1 THEN 'unexpected name' WHEN size = 0 THEN 'empty file' END
  AS reject_reason
FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url || '/diabetic_data.csv' ELSE url END AS url,
        CASE WHEN page_id % 9 <> 0 THEN CAST(length(html) AS INTEGER) ELSE 0 END AS size FROM pages)"""

# --- profiling ---
SQL["profile_shape"] = "SELECT count(*) AS row_count, 50 AS column_count FROM raw"


def null_share(c):
    return f"coalesce({half_up(f'count(*) - count({c})', 'count(*)', 2, 100)}, 0.0)"


NULL_ROWS = union(f"SELECT {q(c)} AS column_name, count(*) - count({c}) AS null_count, {null_share(c)} AS "
                  "null_percentage FROM blanked" for c in ENCOUNTER_COLUMNS)
NULLS = f"""SELECT *, CASE WHEN null_percentage = 0 THEN 'Aucune valeur manquante' WHEN null_percentage < 5 THEN 'Faible'
  WHEN null_percentage < 20 THEN 'Modéré' WHEN null_percentage < 50 THEN 'Élevé' ELSE 'Critique' END AS severity
FROM ({NULL_ROWS})"""
SQL["profile_nulls"] = NULLS
SQL["profile_mostly_missing"] = f"SELECT * FROM ({NULLS}) WHERE null_percentage >= 40"
SQL["profile_quality_summary"] = union(
    f"SELECT {q(c)} AS column_name, 'string' AS data_type, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS unique_count, {null_share(c)} AS null_percentage "
    "FROM blanked" for c in ENCOUNTER_COLUMNS)
SQL["profile_tokens"] = "SELECT * FROM (" + union(
    f"SELECT {q(c)} AS column_name, count(*) FILTER ({c} = '?') AS question_mark_count, "
    f"{half_up(f'''count(*) FILTER ({c} = '?')''', 'count(*)', 2, 100)} AS percentage FROM raw"
    for c in ENCOUNTER_COLUMNS) + ") WHERE question_mark_count > 0"
SQL["profile_constant"] = ("SELECT column_name, unique_count FROM (" + SQL["profile_quality_summary"]
                           + ") WHERE unique_count <= 1")
SQL["profile_categories"] = categories("blanked", (
    "race", "gender", "age", "medical_specialty", "a1c_result", "max_glu_serum", "insulin", "change", "diabetesmed",
    "diag_1", "metformin", "readmitted"))


def category(source, column):
    return (f"SELECT {column}, count(*) AS count, {half_up('count(*)', f'(SELECT count(*) FROM {source})', 2, 100)} "
            f"AS percentage FROM {source} GROUP BY {column}")


SQL["profile_top_codes"] = category("blanked", "diag_1") + " ORDER BY count DESC, diag_1 NULLS FIRST LIMIT 20"
SQL["profile_target"] = ("WITH t AS (SELECT CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_30_days "
                         "FROM raw) " + category("t", "readmitted_30_days"))
SQL["profile_duplicates"] = ("SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT "
                             + ", ".join(ENCOUNTER_COLUMNS) + " FROM raw)) AS duplicate_row_count")
SQL["profile_repeated_patients"] = ("SELECT patient_nbr, count(*) AS encounter_count FROM raw GROUP BY patient_nbr "
                                    "HAVING count(*) > 1")
SQL["profile_top_patients"] = ("SELECT patient_nbr, count(*) AS encounter_count FROM raw GROUP BY patient_nbr "
                               "ORDER BY encounter_count DESC, patient_nbr LIMIT 20")
SQL["profile_repeated_encounters"] = ("SELECT encounter_id, count(*) AS count FROM raw GROUP BY encounter_id "
                                      "HAVING count(*) > 1")
CHECKED = ("readmitted", "gender", "age", *MEDICATIONS)
SQL["profile_unexpected"] = union(
    f"SELECT {q(c)} AS column_name, count(DISTINCT {c}) AS unexpected_count, count(*) = 0 AS is_valid FROM blanked "
    f"WHERE {c} NOT IN ({listed(ALLOWED_VALUES[c])})" for c in CHECKED)
SQL["profile_unexpected_values"] = union(
    f"SELECT {q(c)} AS column_name, {c} AS value, count(*) AS rows FROM blanked "
    f"WHERE {c} NOT IN ({listed(ALLOWED_VALUES[c])}) GROUP BY {c}" for c in CHECKED)


def described(source, columns, kind):
    def rank(p):
        return f"max(v) FILTER (rn = CAST(floor((n - 1) * {p} + 0.5) AS BIGINT) + 1)"

    return union(f"""
SELECT {q(c)} AS column_name, count(v) AS count, count(*) - count(v) AS null_count,
  CAST(sum(v) AS DOUBLE) / count(v) AS mean,
  sqrt(greatest(0, CAST(sum(v * v) AS DOUBLE) - CAST(sum(v) AS DOUBLE) * CAST(sum(v) AS DOUBLE) / count(v))
       / (count(v) - 1)) AS std,
  CAST(min(v) AS DOUBLE) AS min, CAST({rank(0.25)} AS DOUBLE) AS q25, CAST({rank(0.5)} AS DOUBLE) AS q50,
  CAST({rank(0.75)} AS DOUBLE) AS q75, CAST(max(v) AS DOUBLE) AS max
FROM (SELECT v, row_number() OVER (ORDER BY v NULLS LAST) AS rn, count(v) OVER () AS n
      FROM (SELECT CAST({c} AS {kind}) AS v FROM {source}))""" for c in columns)


SQL["profile_describe"] = f"WITH n AS ({NUMBER_ROWS}) " + described("n", MAIN_NUMBERS, "BIGINT")
SQL["profile_describe_lineitem"] = described("lineitem", ("l_quantity", "l_extendedprice", "l_discount"),
                                             "DECIMAL(19, 4)")


def histogram(column, bins):
    return f"""
SELECT {q(column)} AS column_name, CAST(b AS INTEGER) AS bin, low + b * w AS lower, low + (b + 1) * w AS upper,
  (SELECT count(*) FROM curated WHERE least(CAST(floor(({column} - low) / w) AS BIGINT), {bins - 1}) = b) AS count
FROM (SELECT CAST(min({column}) AS DOUBLE) AS low, (max({column}) - min({column})) / {bins} AS w FROM curated),
  range({bins}) AS r(b)"""


SQL["profile_histogram"] = union([histogram("time_in_hospital", 14), histogram("num_medications", 30),
                                  histogram("num_procedures", 8)])


def rates(bucket, name, more=""):
    return (f"SELECT {bucket} AS {name}, avg(readmitted_30_days) AS rate, count(*) AS count FROM explored "
            f"GROUP BY {bucket} {more}")


SQL["rate_by_visits"] = rates("CASE WHEN total_previous_visits >= 5 THEN '5+' ELSE CAST(total_previous_visits AS "
                              "VARCHAR) END", "visits_bucket")
SQL["rate_by_stay"] = rates("time_in_hospital", "time_in_hospital")
SQL["rate_by_age"] = rates("age", "age")
SQL["rate_by_insulin"] = rates("insulin_prescribed", "insulin_prescribed")
SQL["rate_by_admission_type"] = rates("admission_type_id", "admission_type_id", "HAVING count(*) >= 100")
PER_PATIENT = "(SELECT patient_nbr, count(*) AS n FROM explored GROUP BY patient_nbr)"
SQL["admissions_per_patient"] = ("SELECT CASE WHEN n >= 5 THEN '5+' ELSE CAST(n AS VARCHAR) END AS bucket, "
                                 f"count(*) AS entities FROM {PER_PATIENT} GROUP BY 1")
SQL["several_admissions_share"] = f"""
SELECT count(*) AS entities, count(*) FILTER (n > 1) AS entities_with_several, sum(n) / count(*) AS rows_per_entity,
  count(*) FILTER (n > 1) / count(*) AS several_share FROM {PER_PATIENT}"""
SQL["family_counts"] = ("WITH layers_known AS (SELECT diag_1_group FROM explored WHERE diag_1_group IS NOT NULL) "
                        + category("layers_known", "diag_1_group"))
SQL["status_shares"] = ("SELECT readmitted, count(*) AS count, "
                        f"{half_up('count(*)', '(SELECT count(*) FROM explored)', 4)} AS share FROM explored "
                        "GROUP BY readmitted")

# --- models ---
SQL["model_rows"] = "SELECT * FROM model_rows"
SQL["split_assignment"] = """
WITH classes AS (
  SELECT readmitted_30_days AS label, count(*) AS n_c, (SELECT count(*) FROM model_rows) AS n
  FROM model_rows GROUP BY 1),
sized AS (SELECT *, CAST(ceil(n * 0.2) AS BIGINT) AS test FROM classes),
whole AS (SELECT *, (test * n_c) // n AS base, (test * n_c) % n AS rest FROM sized),
quotas AS (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= test - sum(base) OVER ()
    THEN 1 ELSE 0 END AS test_rows FROM whole)
SELECT encounter_id, readmitted_30_days, CAST(row_number() OVER (PARTITION BY readmitted_30_days
  ORDER BY md5('42:' || CAST(encounter_id AS VARCHAR)), encounter_id) <= test_rows AS INTEGER) AS is_test
FROM model_rows JOIN quotas ON label = readmitted_30_days"""
_CATEGORICAL = ("gender", "race", "admission_type_id", "discharge_disposition_id", "admission_source_id",
                "max_glu_serum", "a1c_result", "change", "diabetesmed", "insulin_prescribed", "diag_1_group")
SQL["encoded_categories"] = SQL["split_assignment"].replace(
    "\nSELECT encounter_id, readmitted_30_days, CAST(",
    ",\nsplit AS (SELECT encounter_id, readmitted_30_days, CAST(") + """),
cells AS (UNPIVOT (SELECT m.encounter_id, is_test, {columns} FROM model_rows m JOIN split s USING (encounter_id))
  ON {columns} INTO NAME column_name VALUE value),
ranked AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) - 1 AS slot
  FROM (SELECT column_name AS c, value AS v, count(*) AS n FROM cells WHERE is_test = 0 GROUP BY 1, 2))
SELECT encounter_id, column_name, slot FROM cells LEFT JOIN ranked ON c = column_name AND v = value
WHERE is_test = 1""".replace("{columns}", ", ".join(_CATEGORICAL))
SQL["class_weights"] = """
SELECT readmitted_30_days, class_rows, n / (k * class_rows) AS class_weight, (n - class_rows) / class_rows AS others_ratio
FROM (SELECT readmitted_30_days, count(*) AS class_rows, sum(count(*)) OVER () AS n, count(*) OVER () AS k
      FROM model_rows GROUP BY 1)"""


def moments(c):
    n, s, ss = f"count({c})", f"CAST(sum({c}) AS HUGEINT)", f"CAST(sum({c} * {c}) AS HUGEINT)"
    std = f"(sqrt(CAST({n} * {ss} - {s} * {s} AS DOUBLE)) / {n})"
    return (f"SELECT {q(c)} AS column_name, sum({c}) / count({c}) AS mean, "
            f"CASE WHEN {std} > 0 THEN {std} ELSE 1.0 END AS std FROM model_rows")


SQL["scaling"] = union(map(moments, MODEL_NUMERIC))
SQL["standard_scores"] = "SELECT encounter_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END, 6) "
    f"AS {c}" for c in MODEL_NUMERIC) + " FROM model_rows"
SQL["category_codes"] = """WITH shown AS (SELECT coalesce(CAST(insulin_prescribed AS VARCHAR), 'None') AS
  insulin_prescribed, coalesce(diag_1_group, 'None') AS diag_1_group, race FROM encounters) """ + categories(
    "shown", ("insulin_prescribed", "diag_1_group", "race"))
CONFUSION = """
SELECT count(*) FILTER (y_true = 0 AND y_pred = 0) AS true_negative,
  count(*) FILTER (y_true = 0 AND y_pred = 1) AS false_positive,
  count(*) FILTER (y_true = 1 AND y_pred = 0) AS false_negative,
  count(*) FILTER (y_true = 1 AND y_pred = 1) AS true_positive FROM scored"""


def guarded(a, b):
    return f"round(CASE WHEN {b} = 0 THEN 0.0 ELSE ({a}) / ({b}) END, 4)"


METRICS = f"""SELECT *, {guarded('true_positive', 'true_positive + false_positive')} AS precision,
  {guarded('true_positive', 'true_positive + false_negative')} AS recall,
  {guarded('true_positive', 'true_positive + false_negative')} AS sensitivity,
  {guarded('true_negative', 'true_negative + false_positive')} AS specificity,
  {guarded('2 * true_positive', '2 * true_positive + false_positive + false_negative')} AS f1_score
FROM ({CONFUSION})"""
SQL["class_metrics"] = METRICS


def areas(score):
    """ROC area by comparing every positive with every negative; average precision by thresholds."""
    return f"""
SELECT round((SELECT sum(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0 END) / count(*)
    FROM (SELECT {score} AS s FROM scored WHERE y_true = 1) p, (SELECT {score} AS s FROM scored WHERE y_true = 0) n), 4)
    AS roc_auc,
  round((SELECT sum(pos * (tp / seen)) / sum(pos) FROM (
    SELECT pos, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS seen
    FROM (SELECT {score} AS s, count(*) FILTER (y_true = 1) AS pos, count(*) AS n FROM scored GROUP BY 1))), 4) AS pr_auc"""


SQL["ranking_metrics"] = areas("score")
SQL["model_evaluation"] = f"SELECT * FROM ({METRICS}), ({areas('score')})"
SQL["model_choice"] = f"""
SELECT *, roc_auc = max(roc_auc) OVER () AS is_best FROM (
  SELECT 'score' AS model_name, * FROM ({METRICS}), ({areas('score')})
  UNION ALL SELECT 'inverse_score' AS model_name, * FROM ({METRICS}), ({areas('(1 - score)')}))"""
SQL["risk_thresholds"] = "SELECT * FROM thresholds"
SQL["risk_bands"] = "SELECT * FROM banded"
SQL["risk_distribution"] = "SELECT predicted_risk_category, count(*) AS rows FROM banded GROUP BY 1"
SQL["outcome_by_band"] = ("SELECT predicted_risk_category, count(*) AS encounters, avg(y_true) AS actual_rate "
                          "FROM banded GROUP BY 1")
SQL["risk_kpis"] = ("SELECT count(*) FILTER (predicted_risk_category = 'High') AS high_risk, "
                    "avg(score) AS mean_probability FROM banded")
# fixed values of the request: range of each number (None: open), codes without a range, texts
_RANGES = {
    "time_in_hospital": (1, 14), "num_lab_procedures": (0, None), "num_procedures": (0, None),
    "num_medications": (0, None), "number_diagnoses": (1, 16), "age_midpoint": (0, 100),
    "total_previous_visits": (0, None), "healthcare_utilization_score": (0, None),
    "patient_complexity_score": (0, None), "active_medications_count": (0, None),
    "medication_dosage_changes_count": (0, None), "insulin_prescribed": (0, 1)}
_CODES = ("admission_type_id", "discharge_disposition_id", "admission_source_id")
_TEXTS = ("gender", "race", "max_glu_serum", "a1c_result", "change", "diabetesmed", "diag_1_group")
_SPOILT = {
    "age_midpoint": (211, 3, "'101'"), "time_in_hospital": (223, 5, "'3.5'"), "admission_type_id": (227, 7, "'urgent'"),
    "insulin_prescribed": (229, 9, "'2'"), "change": (233, 11, "NULL"), "patient_complexity_score": (239, 13, "'-1'")}


def _request(c):
    plain = f"CAST({c} AS VARCHAR)"
    if c not in _SPOILT:
        return f"{plain} AS {c}"
    n, r, bad = _SPOILT[c]
    return f"CASE WHEN encounter_id % {n} = {r} THEN {bad} ELSE {plain} END AS {c}"


def _refused(c):
    if c in _RANGES:
        low, high = _RANGES[c]
        inside = f"TRY_CAST({c} AS BIGINT) >= {low}" + (f" AND TRY_CAST({c} AS BIGINT) <= {high}" if high else "")
        wrong = f"NOT coalesce(regexp_full_match({c}, '[+-]?[0-9]+') AND {inside}, false)"
        reason = f"{c} must be at least {low}" if high is None else f"{c} must be {low} to {high}"
    elif c in _CODES:
        wrong, reason = f"NOT regexp_full_match({c}, '[+-]?[0-9]+')", f"{c} must be a whole number"
    else:
        wrong, reason = "false", ""
    return (f"SELECT row_id, CASE WHEN {c} IS NULL THEN 'required_value' ELSE 'invalid_numeric_value' END AS rule_name, "
            f"{q(c)} AS column_name, coalesce({c}, '<NULL>') AS invalid_value, "
            f"CASE WHEN {c} IS NULL THEN {q(c + ' is required')} ELSE {q(reason)} END AS rejection_reason "
            f"FROM requests WHERE {c} IS NULL OR {wrong}")


_FIELDS = (*_RANGES, *_CODES, *_TEXTS)
SQL["request_checks"] = ("WITH requests AS (SELECT encounter_id AS row_id, " + ", ".join(map(_request, _FIELDS))
                         + " FROM encounters) " + union(map(_refused, _FIELDS)))

# --- files and tables ---
SQL["csv_as_text"] = ("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
                      "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer")
SQL["csv_inferred"] = "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
SQL["stored_layer_counts"] = "SELECT count(*) AS row_count, count(DISTINCT o_custkey) AS distinct_count FROM orders"
SQL["bound_parameters"] = ("SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderkey % 7 <> 3 "
                           "GROUP BY o_custkey")
SQL["replaced_table"] = "SELECT * FROM supplier"
SQL["versioned_table"] = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0"
SQL["written_file_hashes"] = """
SELECT part, octet_length(encode(content)) AS length, sha256(content) AS sha256 FROM (
  SELECT o_orderkey // 1000 AS part, string_agg(o_orderkey || '|' || o_custkey || chr(10), '' ORDER BY o_orderkey) AS content
  FROM orders GROUP BY 1)"""
SQL["refilled_table"] = "SELECT * FROM part"
SQL["mart_views"] = ("SELECT gender, race, CAST(sum(total_encounters) AS BIGINT) AS encounters FROM mart_patients "
                     "GROUP BY gender, race")
SQL["numbered_rows"] = "SELECT count(*) AS row_count, count(*) AS id_count FROM lineitem"

# --- legacy extract, reports, whole chain ---
SQL["legacy_clean"] = """
WITH stays AS (
  SELECT o.o_orderkey AS stay_id,
    CASE WHEN o.o_orderkey % 401 = 3 THEN 'n/a'
         WHEN o.o_orderkey % 419 = 7 THEN CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) || ' 08:30:00' ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS date_entree,
    CAST(CAST(max(l.l_shipdate) AS DATE) AS VARCHAR) AS date_sortie,
    CASE WHEN o.o_orderkey % 409 = 5 THEN 'inconnu' WHEN o.o_orderkey % 431 = 11 THEN '12d' WHEN o.o_orderkey % 6 = 0 THEN ''
         ELSE CAST(o.o_custkey % 90 + 5 AS VARCHAR) END AS age,
    CASE CASE WHEN o.o_orderkey % 8 = 0 THEN 9 ELSE o.o_orderkey % 4 END WHEN 9 THEN chr(9) || 'Oui' || chr(10)
      WHEN 0 THEN ' Oui ' WHEN 1 THEN 'non' WHEN 2 THEN 'NON' ELSE NULL END AS diabete,
    CASE o.o_orderkey % 3 WHEN 0 THEN 'h' WHEN 1 THEN 'F ' ELSE '?' END AS sexe,
    CASE WHEN o.o_custkey % 14 = 2 THEN chr(9) || 'oui' WHEN o.o_custkey % 2 = 0 THEN 'oui' ELSE 'non' END AS rehospitalise_30j,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(o.o_orderkey % 60 AS VARCHAR) END
      AS delai_depuis_derniere_hosp_jours
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_orderkey, o.o_orderdate, o.o_custkey),
first_entry AS (SELECT arg_min(date_entree, stay_id) FILTER (date_entree <> '') AS text FROM stays),
dated AS (SELECT stays.* REPLACE (CASE
    WHEN regexp_full_match(text, '\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(date_entree, '%Y-%m-%d')
    WHEN regexp_full_match(text, '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}') THEN try_strptime(date_entree, '%Y-%m-%d %H:%M:%S')
    ELSE TRY_CAST(date_entree AS TIMESTAMP) END AS date_entree) FROM stays, first_entry)
SELECT * FROM (
  SELECT stay_id, CAST(CAST(date_entree AS DATE) AS VARCHAR) AS date_entree, date_sortie,
    TRY_CAST(age AS DOUBLE) AS age,
    CASE lower(trim(diabete, ' ' || chr(9) || chr(10))) WHEN 'oui' THEN 1 WHEN 'non' THEN 0 END AS diabete,
    CASE upper(trim(sexe)) WHEN 'H' THEN 1 WHEN 'F' THEN 0 END AS sexe,
    CASE trim(rehospitalise_30j, chr(9)) WHEN 'oui' THEN 1 WHEN 'non' THEN 0 END AS rehospitalise_30j,
    coalesce(TRY_CAST(delai_depuis_derniere_hosp_jours AS DOUBLE), 999.0) AS delai_depuis_derniere_hosp_jours,
    CAST(CAST(date_sortie AS DATE) - CAST(date_entree AS DATE) AS DOUBLE) AS duree_sejour
  FROM dated)
WHERE age IS NOT NULL AND date_entree IS NOT NULL AND date_sortie IS NOT NULL AND rehospitalise_30j IS NOT NULL"""
SQL["quality_report"] = f"""
SELECT CAST(to_json({{
  'summary': (SELECT {{'total_rows': total_rows, 'valid_rows': valid_rows, 'rejected_rows': rejected_rows,
    'total_violations': total_violations, 'duplicate_rows': duplicate_rows,
    'valid_rate_percent': valid_rate_percent}} FROM ({RUN_TOTALS})),
  'violations': (SELECT list({{'rule_name': rule_name, 'column_name': column_name,
    'rejection_reason': rejection_reason, 'violation_count': n}} ORDER BY rule_name, column_name)
    FROM (SELECT rule_name, column_name, rejection_reason, count(*) AS n FROM violations GROUP BY ALL)),
  'missing_values': (SELECT list({{'column_name': column_name, 'missing_count': missing_count,
    'missing_rate_percent': missing_rate_percent}} ORDER BY column_name) FROM ({MISSING_SUMMARY}))
}}) AS VARCHAR) AS document"""
SQL["chain_status"] = union(
    f"SELECT {q(step)} AS step, 'SUCCESS' AS status, count(*) AS rows FROM {t}" for step, t in (
        ("ingestion", "raw"), ("validation", "valid"), ("etl", "curated"), ("feature_engineering", "features"),
        ("data_warehouse", "fact_hospitalization"), ("data_marts", "mart_readmission")))

SQL["chain_quality_runs"] = f"""
SELECT 'diabetic_data.csv' AS raw_file_name, 'SUCCESS' AS status, total_rows, valid_rows, rejected_rows, total_violations,
  duplicate_rows, valid_rate_percent, true AS finished FROM ({RUN_TOTALS})"""
SQL["chain_rule_results"] = ("SELECT rule_name, column_name, count(*) AS violation_count, rejection_reason AS description "
                             "FROM violations GROUP BY rule_name, column_name, rejection_reason")
SQL["chain_etl_runs"] = """
SELECT 'curated' AS target_table, 'SUCCESS' AS status, (SELECT count(*) FROM valid) AS input_rows, count(*) AS output_rows,
  (SELECT count(*) FROM valid) - count(*) AS duplicates_removed, 50 AS source_columns, 53 AS output_columns,
  count(*) AS stored_rows FROM curated"""
SQL["chain_import_runs"] = ("SELECT 'diabetic_data.csv' AS source_file_name, 'SUCCESS' AS status, count(*) AS rows, "
                            "'SUCCESS' AS run_status FROM raw")
SQL["chain_readmission"] = "SELECT * FROM mart_readmission"


def _complete(sql: str) -> str:
    """Put the layers in front; a statement with its own WITH keeps its parts after them."""
    layered = with_layers(sql)
    if layered is sql or not sql.lstrip().startswith("WITH "):
        return layered
    prefix = layered[: len(layered) - len(sql)].rstrip()
    return prefix + ",\n" + sql.lstrip()[len("WITH "):]


ORACLES = {name: _complete(sql) for name, sql in SQL.items()}
