"""Stacked reference file: three small tables under one another, each opened by a header and closed by a blank line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import literal, strip
from ..operators.order import carry_forward
from ..schema import NO_DESCRIPTION, REFERENCE_SECTIONS

# The published code lists (identifier, description), in file order.
ADMISSION_TYPES = (
    (1, "Emergency"), (2, "Urgent"), (3, "Elective"), (4, "Newborn"), (5, "Not Available"), (6, "NULL"),
    (7, "Trauma Center"), (8, "Not Mapped"),
)
DISCHARGE_DISPOSITIONS = (
    (1, "Discharged to home"),
    (2, "Discharged/transferred to another short term hospital"),
    (3, "Discharged/transferred to SNF"),
    (4, "Discharged/transferred to ICF"),
    (5, "Discharged/transferred to another type of inpatient care institution"),
    (6, "Discharged/transferred to home with home health service"),
    (7, "Left AMA"),
    (8, "Discharged/transferred to home under care of Home IV provider"),
    (9, "Admitted as an inpatient to this hospital"),
    (10, "Neonate discharged to another hospital for neonatal aftercare"),
    (11, "Expired"),
    (12, "Still patient or expected to return for outpatient services"),
    (13, "Hospice / home"),
    (14, "Hospice / medical facility"),
    (15, "Discharged/transferred within this institution to Medicare approved swing bed"),
    (16, "Discharged/transferred/referred another institution for outpatient services"),
    (17, "Discharged/transferred/referred to this institution for outpatient services"),
    (18, "NULL"),
    (19, '"Expired at home. Medicaid only, hospice."'),
    (20, '"Expired in a medical facility. Medicaid only, hospice."'),
    (21, '"Expired, place unknown. Medicaid only, hospice."'),
    (22, "Discharged/transferred to another rehab fac including rehab units of a hospital ."),
    (23, "Discharged/transferred to a long term care hospital."),
    (24, "Discharged/transferred to a nursing facility certified under Medicaid but not certified under Medicare."),
    (25, "Not Mapped"),
    (26, "Unknown/Invalid"),
    (30, "Discharged/transferred to another Type of Health Care Institution not Defined Elsewhere"),
    (27, "Discharged/transferred to a federal health care facility."),
    (28, "Discharged/transferred/referred to a psychiatric hospital of psychiatric distinct part unit of a hospital"),
    (29, "Discharged/transferred to a Critical Access Hospital (CAH)."),
)
ADMISSION_SOURCES = (
    (1, " Physician Referral"), (2, "Clinic Referral"), (3, "HMO Referral"), (4, "Transfer from a hospital"),
    (5, " Transfer from a Skilled Nursing Facility (SNF)"), (6, " Transfer from another health care facility"),
    (7, " Emergency Room"), (8, " Court/Law Enforcement"), (9, " Not Available"),
    (10, " Transfer from critial access hospital"), (11, "Normal Delivery"), (12, " Premature Delivery"),
    (13, " Sick Baby"), (14, " Extramural Birth"), (15, "Not Available"), (17, "NULL"),
    (18, " Transfer From Another Home Health Agency"), (19, "Readmission to Same Home Health Agency"),
    (20, " Not Mapped"), (21, "Unknown/Invalid"),
    (22, " Transfer from hospital inpt/same fac reslt in a sep claim"), (23, " Born inside this hospital"),
    (24, " Born outside this hospital"), (25, " Transfer from Ambulatory Surgery Center"),
    (26, "Transfer from Hospice"),
)


def read_stacked(spark: SparkSession, path: str) -> DataFrame:
    """Lines of stacked files with their number in the file. A whole file is one record: these files are small
    code lists, and ``wholetext`` keeps their line order."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^﻿", "").alias("text"))
        .select("file", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
        .select("file", (F.col("pos") + 1).cast("int").alias("line_no"), "line")
    )


def parse_stacked(lines: DataFrame, sections=tuple(REFERENCE_SECTIONS)) -> DataFrame:
    """``(file, line_no, section, id, description)`` of every data line inside an open section.

    A line whose first cell is a section name opens it, a blank first cell closes it, a non-integer first cell is
    skipped, an empty description gets a label.
    """
    cells = F.from_csv("line", F.lit("head string, description string"))
    parsed = lines.withColumn("cells", cells).select(
        "file", "line_no", strip("cells.head").alias("head"), strip("cells.description").alias("description"))
    blank = F.coalesce(F.col("head") == "", F.lit(True))
    # A marker on opening and closing lines only; '' closes.
    marker = F.when(blank, "").when(F.col("head").isin(*sections), F.col("head"))
    return (
        carry_forward(parsed.withColumn("section", marker), ["line_no"], "section", ["file"])
        .withColumn("id", F.col("head").try_cast("int"))
        .filter((F.col("section") != "") & F.col("id").isNotNull())
        .select("file", "line_no", "section", "id",
                F.coalesce(F.nullif("description", F.lit("")), F.lit(NO_DESCRIPTION)).alias("description"))
    )


def code_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The three published code dimensions as VALUES relations: Spark knows how small they are and broadcasts them
    by itself, whatever they are joined to. The texts are those the parser gives for the published file."""
    out = {}
    for (name, id_column, description), codes in zip(
            REFERENCE_SECTIONS.values(), (ADMISSION_TYPES, DISCHARGE_DISPOSITIONS, ADMISSION_SOURCES)):
        rows = ", ".join(f"({number}, {literal(text.strip().strip(chr(34)))})" for number, text in codes)
        out[name] = spark.sql(f"SELECT * FROM VALUES {rows} AS codes({id_column}, {description})")
    return out


def reference_dimensions(parsed: DataFrame) -> dict[str, DataFrame]:
    """The three code dimensions, split by section."""
    return {
        name: parsed.filter(F.col("section") == section).select(
            F.col("id").alias(id_column), F.col("description").alias(description))
        for section, (name, id_column, description) in REFERENCE_SECTIONS.items()
    }
