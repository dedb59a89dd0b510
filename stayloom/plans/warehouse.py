"""Star schema: conformed dimensions, encounter facts and the encounter × medication bridge.

Generated keys are the rank of the natural key, so two builds of the same data give the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clinical import diagnosis_family
from ..functions.text import ident, literal
from ..operators.order import dense_key, first_per_key
from ..operators.joins import merged
from ..operators.reshape import melt
from ..schema import CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY, DIAGNOSES, MEDICATIONS


def dim_patient(encounters: DataFrame) -> DataFrame:
    """One row per patient with the attributes of the first known encounter (lowest id)."""
    first = first_per_key(encounters, "patient_nbr", "encounter_id", ("gender", "race", "age", "age_midpoint"))
    named = first.withColumnsRenamed({"age": "first_age_bracket", "age_midpoint": "first_age_midpoint"})
    return dense_key(named, ["patient_nbr"], "patient_key")


def diagnosis_codes(curated: DataFrame) -> DataFrame:
    """Distinct codes over the three diagnosis columns, from one scan."""
    return curated.select(F.explode(F.array_compact(F.array(*DIAGNOSES))).alias("diagnosis_code")).distinct()


def dim_diagnosis(curated: DataFrame) -> DataFrame:
    codes = diagnosis_codes(curated).withColumn("diagnosis_group", diagnosis_family("diagnosis_code"))
    return dense_key(codes, ["diagnosis_code"], "diagnosis_key")


def dim_medication(spark: SparkSession) -> DataFrame:
    """The fixed drug list; its keys follow the alphabet. As a VALUES relation it has a known size, so it is the side
    that Spark broadcasts."""
    rows = ", ".join(f"({i}, {literal(name)})" for i, name in enumerate(sorted(MEDICATIONS), start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS drugs(medication_key, medication_name)")


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from the first to the last day of a one-row ``(first_day, last_day)`` frame."""
    d = F.col("full_date")
    iso = F.weekday(d) + 1
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        iso.alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso >= 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first: str = CALENDAR_FIRST_DAY, last: str = CALENDAR_LAST_DAY) -> DataFrame:
    """The calendar dimension; not linked to any fact."""
    return calendar(spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")))


def absent_only(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet: what an insert that ignores conflicts would add."""
    return new.join(merged(stored.select(key)), key, "left_anti").select(*new.columns)


def fact_hospitalization(encounters: DataFrame, patients: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Encounter grain. The diagnosis dimension plays three roles; unknown codes give NULL keys."""
    out = encounters.join(merged(patients.select("patient_nbr", "patient_key")), "patient_nbr")
    for role in DIAGNOSES:
        codes = diagnoses.select(F.col("diagnosis_code").alias(role), F.col("diagnosis_key").alias(f"{role}_key"))
        out = out.join(codes, role, "left")
    return out.select(
        F.col("encounter_id").alias("encounter_key"),
        F.col("patient_key"),
        *(F.col(c).cast("int").alias(c) for c in (
            "admission_type_id", "discharge_disposition_id", "admission_source_id")),
        *(f"{role}_key" for role in DIAGNOSES),
        *(F.col(c).cast("int").alias(c) for c in (
            "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses",
            "total_previous_visits", "healthcare_utilization_score", "patient_complexity_score")),
    )


def fact_readmission(encounters: DataFrame) -> DataFrame:
    return encounters.select(
        F.col("encounter_id").alias("encounter_key"), "readmitted", "readmitted_30_days", "readmitted_flag",
        "is_frequent_patient", "insulin_prescribed", "high_medication_burden_flag")


def prescriptions(curated: DataFrame) -> DataFrame:
    """Encounter × prescribed drug: the 23 drug columns unpivoted in one scan, ``No`` and unknown left out."""
    named = curated.select(F.col("encounter_id").alias("encounter_key"), *MEDICATIONS)
    return melt(named, ["encounter_key"], MEDICATIONS, "medication_name", "status").filter(F.col("status") != "No")


def fact_medication_usage(curated: DataFrame) -> DataFrame:
    """The bridge. Encounters are sorted, not the bridge: an encounter's drugs are laid out in key order behind the sort and
    numbered where they lie, and the drug list needs no join."""
    names = sorted(MEDICATIONS)
    given = curated.select(F.col("encounter_id").alias("encounter_key"), *names).filter(
        " OR ".join(f"{ident(name)} <> 'No'" for name in names))
    drugs = F.inline(F.array(*(
        F.struct(F.lit(key).alias("medication_key"), F.col(name).alias("status")) for key, name in enumerate(names, start=1))))
    rows = dense_key(given, ["encounter_key"], "fact_medication_usage_id",
                     lambda stays: stays.select("encounter_key", drugs).filter("status <> 'No'"))
    return rows.select("fact_medication_usage_id", "encounter_key", "medication_key", "status",
                       F.col("status").isin("Up", "Down").cast("int").alias("dosage_changed"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table in one result."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out
