"""KPI rows, switchable measures, rankings and listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent, ratio
from ..operators.joins import merged
from ..operators.reshape import melt
from ..schema import DIAGNOSES
from .marts import (by_diagnosis_role, encounter_outcomes, mart_hospitalizations, mart_patients, mart_readmission,
                    with_descriptions)

# --- measures as columns: usable in any groupBy --------------------------------------------------------------------

MEASURES = {
    "hospitalizations": lambda: F.count("encounter_key"),
    "readmissions": lambda: F.sum("readmitted_flag"),
    "readmissions_30_days": lambda: F.sum("readmitted_30_days"),
    "readmission_rate": lambda: ratio(F.sum("readmitted_flag"), F.count("*")),
    "readmitted_30_days_rate": lambda: ratio(F.sum("readmitted_30_days"), F.count("*")),
    "readmitted_after_30_days_rate": lambda: F.avg("readmitted_flag") - F.avg("readmitted_30_days"),
    "insulin_rate": lambda: F.avg("insulin_prescribed"),
    "avg_time_in_hospital": lambda: F.avg("time_in_hospital"),
    "avg_previous_visits": lambda: F.avg("total_previous_visits"),
    "avg_num_procedures": lambda: F.avg("num_procedures"),
    "avg_num_lab_procedures": lambda: F.avg("num_lab_procedures"),
    "avg_num_medications": lambda: F.avg("num_medications"),
    "avg_number_diagnoses": lambda: F.avg("number_diagnoses"),
}


def measure(name: str) -> Column:
    """A measure by its name, so that a caller can switch between measures."""
    return MEASURES[name]().alias(name)


def by(df: DataFrame, dimensions: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.groupBy(*dimensions).agg(*(measure(n) for n in names))


def factor_rates(df: DataFrame, factors: Sequence[str], name: str = "readmitted_30_days_rate") -> DataFrame:
    """One measure by each of several factors, from one pass: ``(factor, value, encounters, <measure>)``."""
    long = melt(df, ["encounter_key", "readmitted_30_days", "readmitted_flag"], factors, "factor", "value")
    return long.groupBy("factor", "value").agg(F.count("*").alias("encounters"), measure(name))


def _patient_sums(star) -> DataFrame:
    """Outcome counts per patient: facts are summed up on the key before any label is attached."""
    return encounter_outcomes(star).groupBy("patient_key").agg(
        F.count("encounter_key").alias("encounters"), F.sum("readmitted_30_days").alias("readmitted_30_days"),
        F.sum("readmitted_flag").alias("readmitted_flag"))


def _rates_of_sums(sums: DataFrame, factors: Sequence[str], name: str) -> DataFrame:
    """As :func:`factor_rates`, from rows that already hold counts."""
    part = {"readmitted_30_days_rate": "readmitted_30_days", "readmission_rate": "readmitted_flag"}[name]
    return melt(sums, ["encounters", part], factors, "factor", "value").groupBy("factor", "value").agg(
        F.sum("encounters").alias("encounters"), ratio(F.sum(part), F.sum("encounters")).alias(name))


def patient_factor_rates(star, factors: Sequence[str], name: str = "readmitted_30_days_rate") -> DataFrame:
    """One measure by each of several attributes of the patient."""
    patients = star.dim_patient().select("patient_key", *factors)
    return _rates_of_sums(_patient_sums(star).join(merged(patients), "patient_key"), factors, name)


def stay_factor_rates(star, name: str = "readmitted_30_days_rate") -> DataFrame:
    """One measure by primary diagnosis family and by admission type."""
    sums = encounter_outcomes(star).groupBy("diag_1_key", "admission_type_id").agg(
        F.count("encounter_key").alias("encounters"), F.sum("readmitted_30_days").alias("readmitted_30_days"),
        F.sum("readmitted_flag").alias("readmitted_flag"))
    named = with_descriptions(by_diagnosis_role(sums, star), star, ("admission_type",)).withColumnRenamed(
        "diagnosis_group", "diag_1_group")
    return _rates_of_sums(named, ("diag_1_group", "admission_type_description"), name)


def switched_measure(star, names: Sequence[str], dimension: str = "first_age_bracket") -> DataFrame:
    """One visual whose measure is chosen by name, for each of the names: ``(measure, dimension, value)``."""
    out = None
    for name in names:
        one = patient_factor_rates(star, [dimension], name).select(
            F.lit(name).alias("measure"), F.col("value").alias(dimension), F.col(name).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def patients_by_group(star, dimensions: Sequence[str]) -> DataFrame:
    """Patients with an encounter per group of attributes: keys are reduced before they meet the dimension."""
    seen = star.fact_hospitalization().select("patient_key").distinct()
    return star.dim_patient().select("patient_key", *dimensions).join(merged(seen), "patient_key").groupBy(*dimensions).agg(
        F.count("*").alias("patients"))


def encounters_by_admission(star) -> DataFrame:
    """Encounters by admission type, source and discharge, with their share of all: counted by code, then named."""
    codes = ("admission_type", "admission_source", "discharge_disposition")
    counts = star.fact_hospitalization().groupBy(*(f"{c}_id" for c in codes)).agg(F.count("*").alias("count"))
    named = with_descriptions(counts, star, codes)
    total = star.fact_hospitalization().agg(F.count("*").alias("n")).scalar()
    return melt(named, ["count"], [f"{c}_description" for c in codes], "column_name", "value").groupBy(
        "column_name", "value").agg(F.sum("count").alias("count")).withColumn(
        "percentage", percent(F.col("count"), total, 2))


def rates_by_role(star) -> DataFrame:
    """The same rate through each of the diagnosis roles, from one pass over the facts."""
    outcomes = encounter_outcomes(star).select("readmitted_30_days", F.inline(F.array(*(
        F.struct(F.lit(role).alias("role"), F.col(f"{role}_key").alias("diagnosis_key")) for role in DIAGNOSES))))
    per_key = outcomes.groupBy("role", "diagnosis_key").agg(
        F.count("*").alias("encounters"), F.sum("readmitted_30_days").alias("back30"))
    return per_key.join(star.dim_diagnosis(), "diagnosis_key", "left").groupBy("role", "diagnosis_group").agg(
        F.sum("encounters").alias("encounters"),
        ratio(F.sum("back30"), F.sum("encounters")).alias("readmitted_30_days_rate"))


def distinct_patients(df: DataFrame, dimensions: Sequence[str], key: str = "patient_key") -> DataFrame:
    """Distinct patients per group, counted in two levels."""
    return df.select(*dimensions, key).distinct().groupBy(*dimensions).agg(F.count(key).alias("patients"))


def global_kpis(star) -> DataFrame:
    """The one KPI row; all zeros, never absent, on an empty warehouse.

    Grouping by patient first makes the distinct count an ordinary count.
    """
    per_patient = encounter_outcomes(star).groupBy("patient_key").agg(
        F.count("encounter_key").alias("n"), F.sum("readmitted_flag").alias("back"),
        F.sum("readmitted_30_days").alias("back30"), F.sum("time_in_hospital").alias("days"),
        F.sum("num_medications").alias("drugs"), F.sum("number_diagnoses").alias("diagnoses"))
    n = F.sum("n")

    def average(c):
        return F.coalesce(ratio(F.sum(c), n), F.lit(0.0))

    return per_patient.agg(
        F.coalesce(n, F.lit(0)).alias("total_hospitalizations"),
        F.count("patient_key").alias("total_patients"),
        F.coalesce(F.sum("back"), F.lit(0)).alias("total_readmissions"),
        average("back").alias("readmission_rate"),
        average("back30").alias("readmitted_30_days_rate"),
        average("days").alias("avg_time_in_hospital"),
        average("drugs").alias("avg_num_medications"),
        average("diagnoses").alias("avg_number_diagnoses"),
    )


def activity_kpis(star) -> DataFrame:
    per_patient = encounter_outcomes(star).groupBy("patient_key").agg(
        F.count("encounter_key").alias("n"), F.sum("readmitted_flag").alias("back"),
        F.sum("readmitted_30_days").alias("back30"), F.max("is_frequent_patient").alias("frequent"))
    return per_patient.agg(
        F.sum("n").alias("encounters"),
        F.count("*").alias("patients"),
        F.sum("back").alias("readmissions"),
        F.sum("back30").alias("readmissions_30_days"),
        ratio(F.sum("n"), F.count("*")).alias("encounters_per_patient"),
        F.count_if(F.col("frequent") == 1).alias("frequent_patients"),
    )


def average_kpis(star) -> DataFrame:
    return encounter_outcomes(star).agg(*(measure(m) for m in (
        "readmission_rate", "readmitted_30_days_rate", "readmitted_after_30_days_rate", "insulin_rate",
        "avg_time_in_hospital", "avg_previous_visits", "avg_num_procedures", "avg_num_lab_procedures",
        "avg_num_medications", "avg_number_diagnoses")))


def diagnosis_ranking(star, role: str = "diag_1", level: str = "diagnosis_group",
                      name: str = "readmitted_30_days_rate") -> DataFrame:
    """Diagnoses by frequency with a rate re-aggregated from encounters, through any of the three roles.

    Encounters are counted per diagnosis key before the dimension is attached.
    """
    per_key = encounter_outcomes(star).groupBy(f"{role}_key").agg(
        F.count("encounter_key").alias("encounters"), F.sum("readmitted_30_days").alias("back30"),
        F.sum("readmitted_flag").alias("back"))
    part = {"readmitted_30_days_rate": "back30", "readmission_rate": "back"}[name]
    return by_diagnosis_role(per_key, star, role).groupBy(level).agg(
        F.sum("encounters").alias("encounters"), ratio(F.sum(part), F.sum("encounters")).alias(name),
    ).orderBy(F.desc("encounters"), level)


# --- listings ----------------------------------------------------------------------------------------------------

def where_equal(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters joined by AND; an argument left at None is no filter."""
    return reduce(lambda d, kv: d.filter(F.col(kv[0]) == kv[1]),
                  ((k, v) for k, v in wanted.items() if v is not None), df)


def page(df: DataFrame, key: str, limit: int = 50, offset: int = 0, most: int = 500) -> DataFrame:
    """One page in key order, with the number of rows the listing has in all."""
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be 1..{most} and offset not negative")
    total = df.agg(F.count("*").alias("n")).scalar()
    return df.orderBy(key).offset(offset).limit(limit).withColumn("total", total)


def _page_of(fact: DataFrame, limit: int, offset: int, decorate) -> DataFrame:
    """A page of a fact in key order, labelled afterwards: every encounter has its patient, so the joins drop no
    row and need to see only the page."""
    rows = page(fact, "encounter_key", limit, offset)
    total = fact.agg(F.count("*").alias("n")).scalar()
    return decorate(rows.drop("total")).orderBy("encounter_key").withColumn("total", total)


def patients_page(star, limit: int = 50, offset: int = 0, **wanted) -> DataFrame:
    """A page of patients: filtered, counted and cut in the dimension; only the encounters of the page are summed.

    Every patient of the dimension has an encounter, so the dimension alone tells how many rows the listing has.
    """
    rows = page(where_equal(star.dim_patient(), **wanted), "patient_key", limit, offset)
    total = where_equal(star.dim_patient(), **wanted).agg(F.count("*").alias("n")).scalar()
    return mart_patients(star, rows.drop("total")).orderBy("patient_key").withColumn("total", total)


def patient_detail(star, patient_nbr) -> DataFrame:
    one = star.dim_patient().filter(F.col("patient_nbr") == patient_nbr)
    return mart_patients(star, F.broadcast(one))  # the dimension has a row per patient


def hospitalizations_page(star, limit: int = 50, offset: int = 0) -> DataFrame:
    return _page_of(star.fact_hospitalization(), limit, offset, lambda rows: mart_hospitalizations(star, rows))


def readmissions_page(star, limit: int = 50, offset: int = 0, readmitted_30_days: int | None = None) -> DataFrame:
    wanted = where_equal(star.fact_readmission(), readmitted_30_days=readmitted_30_days)
    return _page_of(wanted, limit, offset, lambda rows: mart_readmission(star, rows))


def newest(df: DataFrame, at: str = "started_at", limit: int = 20, tie: str | None = None) -> DataFrame:
    """Newest rows first."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be 1..200")
    return df.orderBy(F.desc(at), *([F.desc(tie)] if tie else [])).limit(limit)


def top(df: DataFrame, measure_name: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(measure_name), *ties).limit(k)


def detail(df: DataFrame, key: str, value) -> DataFrame:
    """Drill-through: the rows of one key."""
    return df.filter(F.col(key) == value)


def restricted_to(df: DataFrame, principal: str, grants: DataFrame | None = None,
                  column: str = "medical_specialty") -> DataFrame:
    """Row-level security: the rows a principal may see.

    Without grants the principal must equal the row's specialty; with a (principal, specialty) grant table the rows
    of all granted specialties are kept. Who may see what is the grant table itself, which no row has to be copied for.
    """
    if grants is None:
        return df.filter(F.col(column) == principal)
    mine = grants.filter(F.col("principal") == principal).select(F.col("specialty").alias("_granted"))
    return df.join(mine, F.col(column) == F.col("_granted"), "left_semi")


def calendar_drill(calendar_days: DataFrame, **totals: Column) -> DataFrame:
    """Totals per level of the hierarchy year > quarter > month, with subtotals (NULL = all)."""
    return calendar_days.rollup("year_number", "quarter_number", "month_number").agg(
        *(c.alias(n) for n, c in totals.items()), F.grouping_id().cast("int").alias("level"))


# --- run histories -----------------------------------------------------------------------------------------------

def seconds_between(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start).cast("timestamp"), F.col(end).cast("timestamp"))


def etl_kpis(runs: DataFrame, as_of: str) -> DataFrame:
    """Runs, mean duration, last start, its status, failures, and the age of the newest finished run."""
    now = F.to_timestamp(F.lit(as_of))
    return runs.agg(
        F.count("id").alias("runs"),
        F.avg(seconds_between("started_at", "finished_at")).alias("avg_duration_seconds"),
        F.max("started_at").cast("string").alias("last_started_at"),
        F.max_by("status", F.struct("started_at", "id")).alias("last_status"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.timestamp_diff("SECOND", F.max("finished_at").cast("timestamp"), now).alias("freshness_seconds"),
    )


def latest(runs: DataFrame, at: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """The newest row as an aggregate: no sort."""
    return runs.agg(F.max_by(F.struct(*columns), F.struct(at, tie)).alias("r")).select("r.*")
