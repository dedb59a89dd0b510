"""Subject marts over the star schema. Each function returns the definition of one mart as a lazy frame.

Facts are combined on the encounter key first (equal buckets, no shuffle) and aggregated before dimension
attributes are attached, so a dimension is joined to one row per key and not to every encounter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_up, rounded_average
from ..operators.joins import merged
from ..schema import DIAGNOSES


def encounter_outcomes(star) -> DataFrame:
    """Encounter measures and readmission outcome side by side."""
    return star.fact_hospitalization().join(merged(star.fact_readmission()), "encounter_key")


def mart_patients(star, patients: DataFrame | None = None) -> DataFrame:
    """Patient grain: encounters, earlier visits, readmissions, ever a frequent patient; of all patients or of given
    rows of the dimension."""
    outcomes = encounter_outcomes(star)
    if patients is not None:
        stays = star.fact_hospitalization().join(patients.select("patient_key"), "patient_key", "left_semi")
        outcomes = stays.join(merged(star.fact_readmission()), "encounter_key")
    per_patient = outcomes.groupBy("patient_key").agg(
        F.count("encounter_key").alias("total_encounters"),
        F.sum("total_previous_visits").alias("total_previous_visits_sum"),
        F.max("is_frequent_patient").alias("is_frequent_patient_ever"),
        F.sum("readmitted_30_days").alias("readmitted_30_days_count"),
        F.sum("readmitted_flag").alias("readmitted_count"),
    )
    return (merged(star.dim_patient()) if patients is None else patients).join(per_patient, "patient_key").select(
        "patient_key", "patient_nbr", "gender", "race", "first_age_bracket", "first_age_midpoint",
        "total_encounters", "total_previous_visits_sum", "is_frequent_patient_ever",
        "readmitted_30_days_count", "readmitted_count")


def with_descriptions(df: DataFrame, star, names) -> DataFrame:
    reference = star.reference()
    for name in names:
        dimension = reference[f"dim_{name}"]
        df = df.join(dimension, f"{name}_id", "left")  # an unknown code gives a NULL text
    return df


def mart_hospitalizations(star, encounters: DataFrame | None = None) -> DataFrame:
    """Encounter grain with labels, of all encounters or of given rows of the fact."""
    facts = star.fact_hospitalization() if encounters is None else encounters
    patients = star.dim_patient().select("patient_key", "gender", "race", "first_age_bracket")
    patients = merged(patients) if encounters is None else patients
    named = with_descriptions(facts.join(patients, "patient_key"), star,
                               ("admission_type", "discharge_disposition", "admission_source"))
    return named.select(
        "encounter_key", "patient_key", "gender", "race", "first_age_bracket", "admission_type_description",
        "discharge_disposition_description", "admission_source_description", "time_in_hospital",
        "num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses", "total_previous_visits",
        "healthcare_utilization_score", "patient_complexity_score")


def by_diagnosis_role(df: DataFrame, star, role: str = "diag_1") -> DataFrame:
    """Attach diagnosis code and group through one of the three roles of the diagnosis dimension."""
    if role not in DIAGNOSES:
        raise ValueError(f"unknown diagnosis role {role}")
    codes = star.dim_diagnosis().select(
        F.col("diagnosis_key").alias(f"{role}_key"), "diagnosis_code", "diagnosis_group")
    return df.join(codes, f"{role}_key", "left")


def mart_readmission(star, outcomes: DataFrame | None = None) -> DataFrame:
    """Encounter grain: outcome and factors, of all encounters or of given rows of the outcome fact."""
    facts = encounter_outcomes(star) if outcomes is None else star.fact_hospitalization().join(
        outcomes, "encounter_key")
    patients = star.dim_patient().select("patient_key", "gender", "race", "first_age_bracket")
    patients = merged(patients) if outcomes is None else patients
    df = by_diagnosis_role(facts.join(patients, "patient_key"), star)
    return with_descriptions(df, star, ("admission_type",)).select(
        "encounter_key", "gender", "race", "first_age_bracket", "admission_type_description",
        F.col("diagnosis_group").alias("diag_1_group"), "time_in_hospital", "total_previous_visits", "readmitted",
        "readmitted_30_days", "readmitted_flag", "is_frequent_patient", "insulin_prescribed",
        "high_medication_burden_flag")


def mart_diagnostics(star) -> DataFrame:
    """Primary-diagnosis grain. Patients are counted in two levels, so no distinct set meets in one task."""
    per_patient = encounter_outcomes(star).filter(F.col("diag_1_key").isNotNull()).groupBy(
        "diag_1_key", "patient_key",
    ).agg(F.count("encounter_key").alias("n"), F.sum("readmitted_30_days").alias("back"),
          F.count("readmitted_30_days").alias("known"), F.sum("time_in_hospital").alias("days"))
    per_code = per_patient.groupBy("diag_1_key").agg(
        F.sum("n").alias("hospitalization_count"),
        F.count("*").alias("patient_count"),
        half_up(F.sum("back"), F.sum("known"), 4).alias("readmitted_30_days_rate"),
        half_up(F.sum("days"), F.sum("n"), 2).alias("avg_time_in_hospital"),
    )
    codes = star.dim_diagnosis().withColumnRenamed("diagnosis_key", "diag_1_key")
    return per_code.join(codes, "diag_1_key").select(
        "diagnosis_code", "diagnosis_group", "hospitalization_count", "patient_count", "readmitted_30_days_rate",
        "avg_time_in_hospital")


def mart_medications(star) -> DataFrame:
    """Drug grain; drugs nobody is given are absent. The bridge holds a drug at most once per encounter, so
    counting rows already counts distinct encounters."""
    used = star.fact_medication_usage().join(
        merged(star.fact_readmission().select("encounter_key", "readmitted_30_days")), "encounter_key",
    ).groupBy("medication_key").agg(
        F.count("*").alias("prescription_count"),
        F.sum("dosage_changed").alias("dosage_change_count"),
        F.count("*").alias("hospitalization_count"),
        rounded_average("readmitted_30_days", 4).alias("readmitted_30_days_rate"),
    )
    return used.join(star.dim_medication(), "medication_key").select(
        "medication_name", "prescription_count", "dosage_change_count", "hospitalization_count",
        "readmitted_30_days_rate")


def valid_rate() -> Column:
    """Valid share in percent, NULL for a run without rows."""
    return F.when(F.col("total_rows") > 0, half_up(F.col("valid_rows"), F.col("total_rows"), 4, 100))


def mart_quality(runs: DataFrame) -> DataFrame:
    """Quality-run grain with the valid rate; keeps whichever of the run columns the history has."""
    wanted = ("quality_run_id", "raw_file_name", "status", "total_rows", "valid_rows", "rejected_rows",
              "total_violations", "duplicate_rows", "valid_rate_percent", "started_at", "finished_at")
    rated = runs.withColumn("valid_rate_percent", valid_rate())
    return rated.select(*(c for c in wanted if c in rated.columns))


def mart_quality_violations(rule_results: DataFrame) -> DataFrame:
    return rule_results.select("quality_run_id", "rule_name", "column_name", "violation_count", "description")


MARTS = {
    "mart_patients": mart_patients,
    "mart_hospitalizations": mart_hospitalizations,
    "mart_readmission": mart_readmission,
    "mart_diagnostics": mart_diagnostics,
    "mart_medications": mart_medications,
}


def create_views(star) -> list[str]:
    """Register every mart as a temporary view: always current, nothing stored."""
    for name, build in MARTS.items():
        build(star).createOrReplaceTempView(name)
    return list(MARTS)
