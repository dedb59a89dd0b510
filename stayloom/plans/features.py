"""Curated table → features. Everything is row-local: no shuffle, one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clinical as c
from ..functions.numbers import half_up
from ..operators.joins import merged
from ..schema import DIAGNOSES, FEATURE_COLUMNS


def with_features(curated: DataFrame) -> DataFrame:
    """Curated columns and feature columns side by side.

    Features are a function of their own curated row, so building facts from this frame equals joining the two
    tables on the encounter key, without the join.
    """
    return curated.withColumns({
        "readmitted_30_days": c.readmitted_30_days(),
        "readmitted_flag": c.readmitted_ever(),
        "age_midpoint": c.age_midpoint(),
        "total_previous_visits": c.previous_visits(),
        "active_medications_count": c.active_medications(),
        "medication_dosage_changes_count": c.dosage_changes(),
        "insulin_prescribed": c.insulin_prescribed(),
        "high_medication_burden_flag": c.high_medication_burden(),
        **{f"{d}_group": c.diagnosis_family(d) for d in DIAGNOSES},
        "patient_complexity_score": c.complexity_score(),
    }).withColumns({
        "healthcare_utilization_score": F.expr("total_previous_visits + time_in_hospital"),
        "is_frequent_patient": c.frequent_patient(),
    })


def features(curated: DataFrame) -> DataFrame:
    return with_features(curated).select(*FEATURE_COLUMNS)


def feature_statistics(curated: DataFrame, table: DataFrame) -> DataFrame:
    """Rows in and out, columns, and the three headline rates."""
    def rate(name):
        return F.coalesce(half_up(F.sum(name), F.count(name), 4), F.lit(0.0)).alias(f"{name}_rate")

    return table.agg(
        F.count("*").alias("output_rows"), rate("readmitted_30_days"), rate("is_frequent_patient"),
        rate("insulin_prescribed"),
    ).select(
        curated.agg(F.count("*").alias("n")).scalar().alias("input_rows"),
        "output_rows",
        F.lit(len(table.columns)).alias("output_columns"),
        "readmitted_30_days_rate",
        F.col("is_frequent_patient_rate").alias("frequent_patient_rate"),
        "insulin_prescribed_rate",
    )


def join_features(curated: DataFrame, table: DataFrame) -> DataFrame:
    """Curated and a separately stored feature table, one to one on the encounter."""
    return curated.join(merged(table.drop("patient_nbr")), "encounter_id")
