"""Named queries: each takes the layers of one input folder and returns a lazy result frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import clinical
from .functions.numbers import percent
from .functions.text import as_category, capped, is_missing, null_if_missing, null_if_token, table_cell
from .operators import ledger, order, profile, quality
from .operators.trend import trend
from .plans import chain, clean, features, legacy, marts, measures, ml, warehouse
from .plans.layers import AS_OF, Layers
from .schema import (ALLOWED_VALUES, DIAGNOSES, ENCOUNTER_COLUMNS, FLAG_COLUMNS, HOSPITAL_RULES, MEDICATIONS,
                     MODEL_NUMERIC, RuleSet)
from .session import shared_folder, staged
from .sources import files, inputs, reference_data

QUERIES: dict[str, Callable[[Layers], DataFrame]] = {}


def query(build: Callable[[Layers], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def text_time(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


# --- raw rows ----------------------------------------------------------------------------------------------------


@query
def raw_encounters(L):
    return L.raw_lazy()


@query
def missing_flags(L):
    return L.raw().select("row_id", *(is_missing(c).cast("int").alias(f"{c}_missing") for c in ENCOUNTER_COLUMNS))


NULL_TOKENS = ("?", "Unknown/Invalid", "NULL", "None", "")


@query
def null_tokens(L):
    return L.raw().select("row_id", *(null_if_token(c, NULL_TOKENS).alias(c) for c in ENCOUNTER_COLUMNS))


@query
def preview_head(L):
    return L.raw().orderBy("row_id").limit(10)


@query
def preview_tail(L):
    return L.raw().orderBy(F.desc("row_id")).limit(5)


VISITS = ("number_outpatient", "number_emergency", "number_inpatient")


def _numbers(L):
    return L.raw().select("row_id", *(F.expr(f"try_cast({c} AS BIGINT) AS {c}") for c in (
        "time_in_hospital", "num_medications", "number_diagnoses", "num_lab_procedures", "num_procedures", *VISITS)))




@query
def anomaly_counts(L):
    return profile.anomaly_counts(_numbers(L), ("time_in_hospital",),
                                  ("num_medications", "number_diagnoses", "num_lab_procedures", *VISITS))


@query
def anomaly_rows(L):
    return profile.anomalies(_numbers(L), ("time_in_hospital", "num_medications"), ("num_lab_procedures",))


@query
def own_specialty_rows(L):
    """Row-level security, caller named like the specialty."""
    rows = measures.restricted_to(L.curated(), "Cardiology")
    return rows.select("encounter_id", "patient_nbr", "medical_specialty")


@query
def granted_specialty_rows(L):
    """Row-level security through a grant table: customers as users."""
    grants = L.input("customer").select(
        F.col("c_name").alias("principal"),
        F.when(F.col("c_custkey") % 3 == 0, "Cardiology").when(F.col("c_custkey") % 3 == 1, "InternalMedicine")
        .otherwise("Unknown").alias("specialty"))
    rows = measures.restricted_to(L.curated(), "Customer#000000002", grants)
    return rows.select("encounter_id", "patient_nbr", "medical_specialty")


# --- data quality ------------------------------------------------------------------------------------------------


@query
def dq_violations(L):
    return quality.violations(L.raw(), HOSPITAL_RULES, as_of=AS_OF).drop("rejected_at")


@query
def dq_valid_rows(L):
    return quality.valid_rows(L.raw(), HOSPITAL_RULES)


@query
def dq_valid_by_anti_join(L):
    return quality.without_violations(L.raw(), L.violations()).select("row_id", "encounter_id", "patient_nbr")


@query
def dq_quarantine(L):
    return quality.quarantine(L.raw(), HOSPITAL_RULES, AS_OF).drop("rejected_at")


@query
def dq_quarantine_by_join(L):
    return quality.quarantine_from(L.violations(), L.raw(), HOSPITAL_RULES).drop("rejected_at")


@query
def dq_key_duplicates(L):
    return quality.key_duplicates(L.raw(), HOSPITAL_RULES)


@query
def dq_row_duplicates(L):
    return quality.row_duplicates(L.raw(), HOSPITAL_RULES)


@query
def dq_rule_summary(L):
    return quality.violation_summary(L.violations())


@query
def dq_missing_summary(L):
    return quality.missing_summary(L.raw(), ENCOUNTER_COLUMNS)


@query
def dq_run_totals(L):
    return quality.run_totals(L.raw(), L.violations())


LINEITEM_RULES = RuleSet(
    columns=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"),
    bounds={"l_orderkey": (1, None, "order key must be positive"), "l_linenumber": (1, 3, "line must be 1 to 3"),
            "l_suppkey": (2, None, "supplier must be 2 or more")},
    allowed={"l_returnflag": ("A", "N"), "l_linestatus": ("O", "F")},
)


def _as_text(columns):
    return (F.col(c).cast("string").alias(c) for c in columns)


@query
def dq_lineitem(L):
    """The same rule engine on another table, without a key."""
    rows = L.input("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        *_as_text(LINEITEM_RULES.columns))
    return quality.violations(rows, LINEITEM_RULES, as_of=AS_OF).drop("rejected_at")


CUSTOMER_RULES = RuleSet(
    columns=("c_name", "c_nationkey", "c_mktsegment"), key="c_name",
    bounds={"c_nationkey": (0, 20, "nation must be 0 to 20")},
    allowed={"c_mktsegment": ("BUILDING", "AUTOMOBILE", "MACHINERY")},
)


@query
def dq_customer(L):
    rows = L.input("customer").select(F.col("c_custkey").alias("row_id"), *_as_text(CUSTOMER_RULES.columns))
    return quality.violations(rows, CUSTOMER_RULES, as_of=AS_OF).drop("rejected_at")


EVENT_RULES = RuleSet(
    columns=("user_id", "event_type", "value"),
    bounds={"user_id": (1, None, "user must be positive")},
    allowed={"event_type": ("click", "view", "signup", "purchase")},
    optional=frozenset({"event_type"}),
)


@query
def dq_events_summary(L):
    rows = L.input("events").select(
        F.col("event_id").alias("row_id"), "event_type", F.col("user_id").cast("string").alias("user_id"),
        F.floor(F.col("value")).cast("string").alias("value"))
    return quality.violation_summary(quality.violations(rows, EVENT_RULES, as_of=AS_OF))


# --- clean -------------------------------------------------------------------------------------------------------


@query
def clean_curated(L):
    return clean.curated(L.valid(), as_of=AS_OF).withColumn("etl_processed_at", text_time("etl_processed_at"))


@query
def clean_stats(L):
    return clean.clean_statistics(L.valid(), L.curated())


@query
def clean_checks(L):
    return quality.curated_checks(L.curated(), "encounter_id", clean.INTEGER_COLUMNS)


@query
def dedup_keep_first(L):
    """Exact and key duplicates of the raw rows removed, first in input order kept."""
    stripped = L.raw().withColumn("encounter_id", null_if_missing("encounter_id"))
    return order.keep_first(stripped, "encounter_id").select("row_id", "encounter_id", "patient_nbr", "gender")


@query
def stored_reconciliation(L):
    return quality.reconcile(L.valid(), L.curated(), "encounter_id")


# --- features ----------------------------------------------------------------------------------------------------


@query
def feature_table(L):
    return features.features(L.curated())


@query
def feature_stats(L):
    return features.feature_statistics(L.curated(), L.features())


@query
def feature_checks(L):
    return quality.feature_checks(L.features(), "encounter_id", FLAG_COLUMNS)


@query
def diagnosis_family(L):
    codes = F.array_compact(F.array(*(F.col(d) for d in DIAGNOSES)))
    return L.curated().select(F.explode(codes).alias("code")).groupBy("code").agg(
        F.count("*").alias("uses")).withColumn("family", clinical.diagnosis_family("code"))


@query
def curated_with_features(L):
    """The one-to-one join of the two stored tables."""
    return features.join_features(L.curated(), L.features()).select(
        "encounter_id", "patient_nbr", "age", "age_midpoint", "readmitted", "readmitted_30_days", "diag_1",
        "diag_1_group", "total_previous_visits")


# --- star schema -------------------------------------------------------------------------------------------------


@query
def dim_patient(L):
    return warehouse.dim_patient(L.encounters())


@query
def dim_diagnosis(L):
    return warehouse.dim_diagnosis(L.curated())


@query
def fact_hospitalization(L):
    return warehouse.fact_hospitalization(L.encounters(), L.dim_patient(), L.dim_diagnosis())


@query
def fact_readmission(L):
    return warehouse.fact_readmission(L.encounters())


@query
def fact_medication_usage(L):
    return warehouse.fact_medication_usage(L.curated())


@query
def foreign_key_checks(L):
    h, r, m = L.fact_hospitalization(), L.fact_readmission(), L.fact_medication_usage()
    reference = L.reference()
    checks = [
        (h, "patient_key", L.dim_patient(), "patient_key"),
        *((h, f"{d}_key", L.dim_diagnosis(), "diagnosis_key") for d in DIAGNOSES),
        *((h, f"{c}_id", reference[f"dim_{c}"], f"{c}_id")
          for c in ("admission_type", "discharge_disposition", "admission_source")),
        (r, "encounter_key", h, "encounter_key"),
        (m, "medication_key", L.dim_medication(), "medication_key"),
    ]
    out = quality.foreign_keys(m, "encounter_key", h, "encounter_key", "bridge_encounter_key")
    for child, column, parent, key in checks:
        out = out.unionByName(quality.foreign_keys(child, column, parent, key, f"fk_{column}"))
    return out


@query
def unique_key_checks(L):
    out = None
    for name, df, key in (("dim_patient", L.dim_patient(), "patient_nbr"),
                          ("dim_diagnosis", L.dim_diagnosis(), "diagnosis_code"),
                          ("fact_hospitalization", L.fact_hospitalization(), "encounter_key"),
                          ("fact_readmission", L.fact_readmission(), "encounter_key"),
                          ("fact_medication_usage", L.fact_medication_usage(), "fact_medication_usage_id")):
        one = quality.unique_key(df, key).select(F.lit(name).alias("table_name"), "check_name", "failed_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query
def star_counts(L):
    return warehouse.table_counts({
        **L.reference(), "dim_patient": L.dim_patient(), "dim_diagnosis": L.dim_diagnosis(),
        "dim_medication": L.dim_medication(), "dim_date": L.dim_date(),
        "fact_hospitalization": L.fact_hospitalization(), "fact_readmission": L.fact_readmission(),
        "fact_medication_usage": L.fact_medication_usage()})


@query
def absent_patients(L):
    """Insert only absent keys: customers the patient dimension does not hold."""
    new = L.input("customer").select(F.col("c_custkey").alias("patient_nbr"), "c_name")
    return warehouse.absent_only(new, L.dim_patient(), "patient_nbr")


@query
def stacked_sections(L):
    """Section parser over many stacked files: one file per order, one line per order line."""
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    section = F.when(k % 3 == 0, "admission_type_id").when(k % 3 == 1, "discharge_disposition_id").otherwise(
        "admission_source_id")
    line = (
        F.when((n == 1) & (k % 5 != 0), F.concat(section, F.lit(",description")))
        .when((n == 4) & (k % 4 == 0), ",")
        .when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("x"), F.col("l_partkey"), F.lit(",skipped")))
        .when(F.col("l_partkey") % 11 == 0, F.concat(F.col("l_partkey"), F.lit(",")))
        .otherwise(F.concat(F.col("l_partkey"), F.lit(", "), F.col("l_returnflag"), F.lit(" ")))
    )
    # an order may hold a line number twice; part and supplier make it unique
    number = (n.cast("bigint") * 100_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")
    lines = L.input("lineitem").select(k.cast("string").alias("file"), number.alias("line_no"), line.alias("line"))
    return reference_data.parse_stacked(lines)


@query
def reference_code_usage(L):
    """Encounters per reference code; codes of the parsed file nobody uses count 0."""
    out = None
    for name, dimension in L.reference().items():
        key = dimension.columns[0]
        used = L.fact_hospitalization().groupBy(key).agg(F.count("*").alias("n"))
        one = dimension.join(used, key, "left").select(
            F.lit(name).alias("dimension"), F.col(key).alias("code"),
            F.col(dimension.columns[1]).alias("description"), F.coalesce("n", F.lit(0)).alias("encounters"))
        out = one if out is None else out.unionByName(one)
    return out


def _order_days(L):
    dates = L.input("orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    bounds = dates.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    per_day = dates.groupBy("full_date").agg(F.count("*").alias("orders"))
    return warehouse.calendar(bounds).join(per_day, "full_date", "left")


@query
def calendar_days(L):
    """Calendar of the order period with the orders of each day."""
    return _order_days(L).withColumn("full_date", F.col("full_date").cast("string")).withColumn(
        "orders", F.coalesce("orders", F.lit(0)))


@query
def calendar_drill(L):
    return measures.calendar_drill(
        _order_days(L), days=F.count("*"), weekend_days=F.count_if("is_weekend"),
        orders=F.coalesce(F.sum("orders"), F.lit(0)))


# --- marts -------------------------------------------------------------------------------------------------------


@query
def mart_patients(L):
    return marts.mart_patients(L)


@query
def mart_hospitalizations(L):
    return marts.mart_hospitalizations(L)


@query
def mart_readmission(L):
    return marts.mart_readmission(L)


@query
def mart_diagnostics(L):
    return marts.mart_diagnostics(L)


@query
def mart_medications(L):
    return marts.mart_medications(L)


def _quality_runs(L):
    return inputs.quality_runs(L.input("events"))


def _etl_runs(L):
    return inputs.etl_runs(L.input("events"))


@query
def mart_quality(L):
    return marts.mart_quality(_quality_runs(L)).withColumns({
        c: text_time(c) for c in ("started_at", "finished_at")})


@query
def mart_quality_violations(L):
    """Rule results of the run over the encounter extract."""
    results = quality.violation_summary(L.violations()).select(
        F.lit(1).alias("quality_run_id"), "rule_name", "column_name", "violation_count",
        F.col("rejection_reason").alias("description"))
    return marts.mart_quality_violations(results)


@query
def mart_counts(L):
    """Rows per mart; encounter marts must equal the encounter fact."""
    return warehouse.table_counts({
        **{name: build(L) for name, build in marts.MARTS.items()},
        "dim_patient": L.dim_patient(), "fact_hospitalization": L.fact_hospitalization()})


# --- KPIs --------------------------------------------------------------------------------------------------------


@query
def kpi_global(L):
    return measures.global_kpis(L)


@query
def kpi_activity(L):
    return measures.activity_kpis(L)


@query
def kpi_averages(L):
    return measures.average_kpis(L)


@query
def kpi_by_factor(L):
    return measures.patient_factor_rates(L, ("first_age_bracket", "gender", "race"))


@query
def kpi_patients_by_group(L):
    return measures.patients_by_group(L, ("gender", "first_age_bracket", "race"))


@query
def kpi_top_diagnoses(L):
    return measures.diagnosis_ranking(L)


@query
def kpi_top_codes(L):
    ranked = measures.diagnosis_ranking(L, level="diagnosis_code")
    return ranked.filter(F.col("diagnosis_code").isNotNull()).orderBy(F.desc("encounters"), "diagnosis_code")


@query
def kpi_by_role(L):
    """The same rate through each of the three diagnosis roles."""
    return measures.rates_by_role(L)


@query
def kpi_switched_measure(L):
    """One visual, measure chosen by name."""
    return measures.switched_measure(L, ("readmission_rate", "readmitted_30_days_rate"))


@query
def kpi_top_drugs(L):
    return marts.mart_medications(L).orderBy(F.desc("prescription_count"), "medication_name")


@query
def kpi_drug_changes(L):
    used = marts.mart_medications(L)
    return used.select("medication_name", "dosage_change_count",
                       percent(F.col("dosage_change_count"), F.col("prescription_count"), 2).alias("change_percent"))


@query
def readmission_by_family(L):
    """30-day readmission rate by primary diagnosis family and by admission type."""
    return measures.stay_factor_rates(L)


@query
def kpi_encounters_by_admission(L):
    return measures.encounters_by_admission(L)


@query
def kpi_stay_by_complexity(L):
    return L.fact_hospitalization().groupBy("time_in_hospital", "patient_complexity_score").agg(
        F.count("*").alias("encounters"))


@query
def patients_page(L):
    return measures.patients_page(L, limit=50, offset=20, gender="Female", race="Caucasian")


@query
def hospitalizations_page(L):
    return measures.hospitalizations_page(L, limit=50, offset=100)


@query
def readmissions_page(L):
    return measures.readmissions_page(L, limit=25, readmitted_30_days=1)


@query
def encounter_detail(L):
    return measures.detail(marts.mart_readmission(L), "encounter_key", 1234)


@query
def patient_detail(L):
    return measures.patient_detail(L, 77)


# --- run histories and ledgers -----------------------------------------------------------------------------------


@query
def quality_run_list(L):
    runs = measures.newest(marts.mart_quality(_quality_runs(L)), tie="raw_file_name")
    return runs.withColumns({c: text_time(c) for c in ("started_at", "finished_at")})


@query
def etl_run_list(L):
    runs = measures.newest(_etl_runs(L), limit=50, tie="id")
    return runs.select(F.col("id").alias("run_id"), "status", "target_table", "input_rows", "output_rows",
                       text_time("started_at"), text_time("finished_at"),
                       table_cell("error_message").alias("error_message"))


@query
def etl_run_kpis(L):
    return measures.etl_kpis(_etl_runs(L), "2025-01-01 00:00:00").withColumn(
        "last_started_at", F.substring("last_started_at", 1, 19))


@query
def quality_kpis(L):
    rated = marts.mart_quality(_quality_runs(L))
    return rated.agg(
        F.sum("total_rows").alias("rows_imported"), F.sum("valid_rows").alias("rows_valid"),
        F.sum("rejected_rows").alias("rows_rejected"),
        percent(F.sum("valid_rows"), F.sum("total_rows"), 4).alias("score"))


@query
def quality_latest(L):
    return measures.latest(marts.mart_quality(_quality_runs(L)), "started_at", "raw_file_name", (
        "raw_file_name", "total_rows", "valid_rows", "rejected_rows", "valid_rate_percent"))


@query
def quality_trend(L):
    rated = marts.mart_quality(_quality_runs(L)).select(
        "raw_file_name", text_time("started_at"), F.col("rejected_rows"), "valid_rate_percent")
    return trend(rated, ["started_at", "raw_file_name"], "rejected_rows")


@query
def etl_trend(L):
    done = _etl_runs(L).filter(F.col("output_rows").isNotNull()).select("id", "started_at", "output_rows")
    return trend(done, ["started_at", "id"], "output_rows").withColumn("started_at", text_time("started_at"))


@query
def run_current_state(L):
    """Ledger events of all runs, reduced to the current state of each."""
    runs = _etl_runs(L)
    events = ledger.opened(runs, "id", "started_at", ["target_table"]).unionByName(
        ledger.closed(runs, "id", "status", "finished_at", ["input_rows", "output_rows", "error_message"]))
    return ledger.current_state(events).select(
        "run_id", "status", text_time("started_at"), text_time("finished_at"),
        F.col("details")["output_rows"].cast("bigint").alias("output_rows"),
        F.col("details")["error_message"].alias("error_message"))


def _ledger(L):
    return inputs.file_ledger(L.input("documents"), L.input("labels"))


@query
def file_fingerprints(L):
    return _ledger(L)


@query
def import_decisions(L):
    files_ = _ledger(L)
    return ledger.import_decisions(files_.filter("status = 'NEW'").select("id", "source_file_name", "sha256"), files_)


@query
def import_new_only(L):
    files_ = _ledger(L)
    return ledger.to_import(files_.filter("status = 'NEW'").select("id", "sha256"), files_)


@query
def import_admission(L):
    """Admission rules on page addresses and sizes."""
    pages = L.input("pages").select("page_id", "url", F.when(F.col("page_id") % 9 != 0, F.length("html")).otherwise(0)
                                    .alias("size"))
    names = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("/diabetic_data.csv"))).otherwise(F.col("url"))
    return files.admission(pages.withColumn("url", names), name="url", size="size")


# --- profiling ---------------------------------------------------------------------------------------------------


def _blanked(L):
    """Raw rows as the exploration reads them: ``?`` and empty text are NULL."""
    return L.raw().select("row_id", *(null_if_token(c, ("?", "")).alias(c) for c in ENCOUNTER_COLUMNS))


@query
def profile_shape(L):
    return profile.shape(L.raw().drop("row_id"))


@query
def profile_quality_summary(L):
    return profile.quality_summary(_blanked(L).drop("row_id"))


@query
def profile_nulls(L):
    return profile.null_summary(_blanked(L).drop("row_id"))


@query
def profile_mostly_missing(L):
    return profile.mostly_missing(profile.null_summary(_blanked(L).drop("row_id")))


@query
def profile_tokens(L):
    return profile.token_summary(L.raw().drop("row_id"))


@query
def profile_constant(L):
    return profile.constant_columns(_blanked(L).drop("row_id"))


@query
def profile_categories(L):
    return profile.category_summaries(_blanked(L), (
        "race", "gender", "age", "medical_specialty", "a1c_result", "max_glu_serum", "insulin", "change",
        "diabetesmed", "diag_1", "metformin", "readmitted"))


@query
def profile_top_codes(L):
    return profile.category_summary(_blanked(L), "diag_1", 20)


@query
def profile_target(L):
    preview = L.raw().select(F.when(F.col("readmitted") == "<30", 1).otherwise(0).alias("readmitted_30_days"))
    return profile.category_summary(preview, "readmitted_30_days", None)


@query
def profile_duplicates(L):
    return profile.duplicate_row_count(L.raw().drop("row_id"))


@query
def profile_repeated_patients(L):
    return profile.repeated(L.raw(), "patient_nbr", "encounter_count")


@query
def profile_top_patients(L):
    return measures.top(L.raw().groupBy("patient_nbr").agg(F.count("*").alias("encounter_count")),
                        "encounter_count", 20, "patient_nbr")


@query
def profile_repeated_encounters(L):
    return profile.repeated(L.raw(), "encounter_id", "count")


CHECKED = {c: ALLOWED_VALUES[c] for c in ("readmitted", "gender", "age", *MEDICATIONS)}


@query
def profile_unexpected(L):
    return profile.unexpected_values(_blanked(L), CHECKED)


@query
def profile_unexpected_values(L):
    return profile.unexpected_value_rows(_blanked(L), CHECKED)


MAIN_NUMBERS = ("time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", *VISITS,
                "number_diagnoses")


@query
def profile_describe(L):
    return profile.describe(_numbers(L), MAIN_NUMBERS, "decimal(18,0)")


@query
def profile_describe_lineitem(L):
    return profile.describe(L.input("lineitem"), ("l_quantity", "l_extendedprice", "l_discount"), "decimal(18,4)")


@query
def profile_histogram(L):
    out = None
    for column, bins in (("time_in_hospital", 14), ("num_medications", 30), ("num_procedures", 8)):
        one = profile.histogram(L.curated(), column, bins).select(F.lit(column).alias("column_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _explored(L):
    """Raw rows, first per key, with the exploration features (counts that are not numbers count as zero)."""
    first = order.keep_first(_blanked(L), "encounter_id")
    return first.withColumns({
        "readmitted_30_days": clinical.readmitted_30_days(), "readmitted_flag": clinical.readmitted_ever(),
        "age_midpoint": clinical.age_midpoint(), "total_previous_visits": clinical.previous_visits(True),
        "insulin_prescribed": clinical.insulin_prescribed(), "diag_1_group": clinical.diagnosis_family("diag_1")})


@query
def rate_by_visits(L):
    return profile.rate_by(_explored(L), capped("total_previous_visits", 5), "visits_bucket")


@query
def rate_by_stay(L):
    return profile.rate_by(_explored(L), F.col("time_in_hospital"), "time_in_hospital")


@query
def rate_by_age(L):
    return profile.rate_by(_explored(L), F.col("age"), "age")


@query
def rate_by_insulin(L):
    return profile.rate_by(_explored(L), F.col("insulin_prescribed"), "insulin_prescribed")


@query
def rate_by_admission_type(L):
    return profile.rate_by(_explored(L), F.col("admission_type_id"), "admission_type_id", at_least=100)


@query
def admissions_per_patient(L):
    return profile.rows_per_entity(_explored(L), "patient_nbr")


@query
def several_admissions_share(L):
    return profile.several_rows_share(_explored(L), "patient_nbr")


@query
def family_counts(L):
    known = _explored(L).filter(F.col("diag_1_group").isNotNull())
    return profile.category_summary(known, "diag_1_group", None)


@query
def status_shares(L):
    return profile.shares(_explored(L), "readmitted")


# --- models ------------------------------------------------------------------------------------------------------


def _scored(L):
    return inputs.scored_rows(L.input("documents"), L.input("labels"))


@query
def model_rows(L):
    return ml.model_rows(L.encounters())


@query
def split_assignment(L):
    return ml.stratified_split(ml.model_rows(L.encounters()), "encounter_id", "readmitted_30_days")


@query
def class_weights(L):
    return ml.class_weights(ml.model_rows(L.encounters()), "readmitted_30_days")


@query
def scaling(L):
    return ml.scaling(ml.model_rows(L.encounters()))


@query
def standard_scores(L):
    rows = ml.model_rows(L.encounters()).select("encounter_id", *MODEL_NUMERIC)
    return ml.standardise(rows).select("encounter_id", *(F.round(c, 6).alias(c) for c in MODEL_NUMERIC))


@query
def category_codes(L):
    """Categories of the model as text, with NULL as its own category."""
    return profile.category_summaries(
        L.encounters().select(*(as_category(c).alias(c) for c in ("insulin_prescribed", "diag_1_group", "race"))),
        ("insulin_prescribed", "diag_1_group", "race"))


@query
def class_metrics(L):
    return ml.class_metrics(_scored(L))


@query
def ranking_metrics(L):
    return ml.ranking_metrics(_scored(L))


@query
def model_evaluation(L):
    return ml.evaluation(_scored(L))


@query
def model_choice(L):
    """Two scores of the same rows compared; the best one is marked."""
    scored = _scored(L)
    inverse = scored.withColumn("score", 1 - F.col("score"))
    return ml.compare({"score": ml.evaluation(scored), "inverse_score": ml.evaluation(inverse)})


@query
def risk_thresholds(L):
    return ml.risk_thresholds(_scored(L))


@query
def risk_bands(L):
    scored = _scored(L)
    return ml.with_risk_band(scored, ml.risk_thresholds(scored))


@query
def risk_distribution(L):
    scored = _scored(L)
    return ml.band_distribution(ml.with_risk_band(scored, ml.risk_thresholds(scored)))


@query
def outcome_by_band(L):
    scored = _scored(L)
    banded = ml.with_risk_band(scored, ml.risk_thresholds(scored)).drop("y_true")
    return ml.outcome_by_band(banded, L.input("labels"), "doc_id", "quality")


@query
def risk_kpis(L):
    scored = _scored(L)
    banded = ml.with_risk_band(scored, ml.risk_thresholds(scored))
    return ml.risk_kpis(banded.withColumnRenamed("score", "predicted_probability"))


@query
def request_checks(L):
    """Checks of all fields of scoring requests: raw values, and the features of encounters, sent as requests.

    Some requests are spoilt on purpose: a text for a number, a number out of its range, a field left out.
    """
    k = F.col("encounter_id")
    rows = L.encounters().select(k.alias("row_id"), *(F.col(c).cast("string").alias(c) for c in ml.REQUEST_FIELDS))
    return ml.request_violations(rows.withColumns({
        "age_midpoint": F.when(F.col("row_id") % 211 == 3, "101").otherwise(F.col("age_midpoint")),
        "time_in_hospital": F.when(F.col("row_id") % 223 == 5, "3.5").otherwise(F.col("time_in_hospital")),
        "admission_type_id": F.when(F.col("row_id") % 227 == 7, "urgent").otherwise(F.col("admission_type_id")),
        "insulin_prescribed": F.when(F.col("row_id") % 229 == 9, "2").otherwise(F.col("insulin_prescribed")),
        "change": F.when(F.col("row_id") % 233 != 11, F.col("change")),
        "patient_complexity_score": F.when(F.col("row_id") % 239 == 13, "-1").otherwise(
            F.col("patient_complexity_score"))}))


@query
def encoded_categories(L):
    """One-hot slots of the categories of held-out rows; a category the training rows do not have is all zeros."""
    return ml.category_slots(*L.train_and_test())


@query
def model_comparison(L):
    """The evaluation report of the three candidates, at their declared sizes, on the held-out rows."""
    folder, _ = L.trained()
    return L.spark.read.parquet(f"{folder}/evaluation")


@query
def fact_prediction(L):
    """All eligible encounters scored by the best stored model, with quantile risk bands. Scores are computed once."""
    folder, best = L.trained()
    scored = staged(ml.score(ml.load_model(folder, best), ml.model_rows(L.encounters(), target=False)), "scores")
    return ml.fact_prediction(scored, best, "1", AS_OF)


# --- files and tables: a given table is written in full and read back ----------------------------------------------


def _place(L, name):
    return f"{shared_folder(L.spark)}/written/{name}-{uuid.uuid4().hex}"


@query
def csv_as_text(L):
    path = _place(L, "customer-csv")
    files.write_csv(L.input("customer"), path)
    return files.read_csv_text(L.spark, path)


@query
def csv_inferred(L):
    path = _place(L, "supplier-csv")
    files.write_csv(L.input("supplier"), path)
    return files.read_csv_inferred(L.spark, path)


@query
def stored_layer_counts(L):
    """Rows and distinct keys of a stored layer, by SQL on its files."""
    path = _place(L, "orders")
    files.write_layer(L.input("orders"), path)
    return files.count_in_file(L.spark, path, "o_custkey")


@query
def bound_parameters(L):
    """SQL text with bound parameters over a registered table."""
    L.input("orders").createOrReplaceTempView("stayloom_orders")
    return files.query(L.spark, "SELECT o_custkey, count(*) AS orders FROM stayloom_orders WHERE o_orderkey % :n <> :r "
                                "GROUP BY o_custkey", n=7, r=3)


@query
def replaced_table(L):
    name = f"stayloom_replaced_{uuid.uuid4().hex}"
    files.replace_table(L.input("supplier"), name, path=_place(L, "supplier"))
    return L.spark.table(name)


@query
def refilled_table(L):
    """A table filled, emptied and filled again with other rows, and then with those it lacks."""
    part, name = L.input("part"), f"stayloom_refilled_{uuid.uuid4().hex}"
    files.replace_table(part.filter("p_size > 40"), name, path=_place(L, "part"))
    files.truncate_insert(part.filter("p_size <= 20"), name)
    files.insert_absent(part, name, "p_partkey")
    return L.spark.table(name)


@query
def versioned_table(L):
    """A table replaced by a frame that reads it, beside replacements that fail and leave it as it is."""
    name, path = f"stayloom_versioned_{uuid.uuid4().hex}", _place(L, "versioned")
    orders = L.input("orders").select("o_orderkey", "o_custkey")
    files.replace_table(orders, name, path)
    files.replace_table(L.spark.table(name).filter("o_orderkey % 3 <> 0"), name, path)
    for refused in (orders.limit(0), orders.select("o_orderkey", F.assert_true(F.lit(False)).cast("int").alias("o_custkey"))):
        try:
            files.replace_table(refused, name, path)
        except Exception:  # what is shown here: the old rows stay
            continue
        raise AssertionError("the replacement must fail")
    return L.spark.table(name)


@query
def written_file_hashes(L):
    """Orders written as one text file per thousand keys, then the size and SHA-256 of every file."""
    path = _place(L, "order-files")
    lines = L.input("orders").select((F.col("o_orderkey") / 1000).cast("bigint").alias("part"), "o_orderkey", F.concat_ws(
        "|", "o_orderkey", "o_custkey").alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("value", "part").write.partitionBy(
        "part").text(path)
    return files.file_hashes(L.spark, path, "part-*").select(
        F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint").alias("part"), "length", "sha256")


@query
def mart_views(L):
    """A mart through its registered view."""
    marts.create_views(L)
    return L.spark.sql("SELECT gender, race, sum(total_encounters) AS encounters FROM mart_patients GROUP BY gender, race")


@query
def numbered_rows(L):
    """Row ids given at read time are unique."""
    return files.with_row_id(L.input("lineitem")).groupBy("row_id").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("id_count"))


# --- legacy extract, reports, whole chain ------------------------------------------------------------------------


@query
def legacy_clean(L):
    stays = inputs.legacy_stays(L.input("orders"), L.input("lineitem"))
    return legacy.legacy_clean(stays, "stay_id").withColumns({c: F.col(c).cast("string") for c in legacy.DATES})


@query
def quality_report(L):
    """The quality run as one JSON document."""
    return files.json_document(
        quality.run_totals(L.raw(), L.violations()),
        violations=quality.violation_summary(L.violations()),
        missing_values=quality.missing_summary(L.raw(), ENCOUNTER_COLUMNS))


@query
def chain_status(L):
    """Steps of a whole run over the raw extract, as its manifest tells them."""
    return chain.chain_status(L.spark, L.chain()).select("step", "status", "rows")


@query
def chain_quality_runs(L):
    """The quality mart over the history the run has written."""
    return marts.mart_quality(chain.quality_history(L.spark, L.chain())).select(
        "raw_file_name", "status", "total_rows", "valid_rows", "rejected_rows", "total_violations", "duplicate_rows",
        "valid_rate_percent", (F.col("finished_at") >= F.col("started_at")).alias("finished"))


@query
def chain_rule_results(L):
    return marts.mart_quality_violations(chain.rule_history(L.spark, L.chain())).drop("quality_run_id")


@query
def chain_etl_runs(L):
    runs = measures.newest(chain.etl_history(L.spark, L.chain()), limit=50, tie="id")
    return runs.select("target_table", "status", "input_rows", "output_rows", "duplicates_removed", "source_columns",
                       "output_columns", "stored_rows")


@query
def chain_import_runs(L):
    """Imports of the run's folder, and whether the pipeline runs they belong to have ended well."""
    imports, runs = chain.import_history(L.spark, L.chain()), chain.run_history(L.spark, L.chain())
    return imports.join(runs.select(F.col("run_id").alias("id"), F.col("status").alias("run_status")), "id").select(
        "source_file_name", "status", "rows", "run_status")


@query
def chain_readmission(L):
    """A mart over the bucketed facts of the run's folder."""
    star = chain.StoredStar(L.spark, L.chain(), L.reference())
    return marts.mart_readmission(star)
