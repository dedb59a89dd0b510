"""Clinical expressions: age midpoints, diagnosis families, readmission flags and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (AGE_BRACKETS, DIABETES_PREFIX, DIAGNOSIS_FAMILIES, FREQUENT_PATIENT_VISITS,
                      HIGH_MEDICATION_BURDEN, MEDICATIONS)
from .text import col, flag, literal, lookup


def age_midpoint(x: str = "age") -> Column:
    """Middle of an age bracket; NULL for any other text."""
    return lookup(x, {bracket: i * 10 + 5 for i, bracket in enumerate(AGE_BRACKETS)})


def diagnosis_family(x: str) -> Column:
    """Clinical family of an ICD-9 code. NULL stays NULL; V and E codes and unknown codes are ``Other``.

    The number of a code is its leading digits, so decimals are cut off; the first matching family wins.
    """
    number = f"CAST(regexp_substr({x}, '^[0-9]+') AS DOUBLE)"
    families = " ".join(
        "WHEN " + " OR ".join(f"{number} BETWEEN {low} AND {high}" for low, high in ranges) + f" THEN {literal(name)}"
        for name, ranges in DIAGNOSIS_FAMILIES)
    return F.expr(f"CASE WHEN {x} IS NULL THEN NULL WHEN startswith({x}, '{DIABETES_PREFIX}') THEN 'Diabetes' "
                  f"{families} ELSE 'Other' END")


def readmitted_30_days(x: str = "readmitted") -> Column:
    return flag(f"{x} = '<30'")


def readmitted_ever(x: str = "readmitted") -> Column:
    return flag(f"{x} <> 'NO'")


def previous_visits(null_as_zero: bool = False) -> Column:
    """Sum of the three earlier-visit counts; NULL if one is unknown, unless NULL counts as zero."""
    parts = ("number_outpatient", "number_emergency", "number_inpatient")
    return F.expr(" + ".join(f"coalesce(try_cast({p} AS BIGINT), 0)" if null_as_zero else p for p in parts))


def frequent_patient(x: str = "total_previous_visits") -> Column:
    return flag(f"{x} >= {FREQUENT_PATIENT_VISITS}")


def high_medication_burden() -> Column:
    return flag(f"num_medications >= {HIGH_MEDICATION_BURDEN}")


def _how_many(condition: str) -> Column:
    """Number of drug states that meet a condition; unknown states do not count."""
    return F.expr(f"size(filter(array({', '.join(MEDICATIONS)}), state -> {condition}))")


def active_medications() -> Column:
    return _how_many("state <> 'No'")


def dosage_changes() -> Column:
    return _how_many("state IN ('Up', 'Down')")


def insulin_prescribed() -> Column:
    return flag("insulin <> 'No'")


def complexity_score() -> Column:
    return F.expr("num_medications + num_procedures + number_diagnoses + time_in_hospital")


def risk_band(probability: str | Column, medium: Column, high: Column) -> Column:
    """Band of a probability; the lower bound of each band is inclusive."""
    p = col(probability)
    return F.when(p < medium, "Low").when(p < high, "Medium").otherwise("High")
