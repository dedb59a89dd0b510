"""Input tables derived from the given Parquet tables.

The hospital extract itself is not public test data here, so its raw table (50 text columns) is a projection of
``orders``; the run histories, file ledger, scored rows and legacy stays are projections of the other tables.
Each function is one scan (or one join) and grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lookup_sql
from ..schema import ENCOUNTER_COLUMNS, MEDICATIONS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_encounters(orders: DataFrame) -> DataFrame:
    """Raw encounter extract with ``row_id`` (input order): one scan of orders, copies added by an explode."""
    key, cust = F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint")
    copies = F.array_compact(F.array(
        F.lit(0),
        F.when(key % 499 == 1, 1),  # the same row again
        F.when(key % 503 == 2, 2),  # the same encounter for another patient
    ))
    src = (
        orders.select(key.alias("k"), cust.alias("c"), F.explode(copies).alias("copy_no"))
        .select("k", "copy_no", (F.col("c") + (F.col("copy_no") == 2).cast("bigint")).alias("p"))
    )
    def pick(value, texts, otherwise):
        return lookup_sql(value, dict(enumerate(texts)), otherwise)

    values = {
        "encounter_id": "CAST(k AS STRING)",
        "patient_nbr": "CAST(p AS STRING)",
        "race": pick("(p + k % 3) % 9", ("?", "AfricanAmerican", "Asian", "Hispanic", "Other"), "Caucasian"),
        "gender": "CASE WHEN k % 997 = 5 THEN 'Unknown/Invalid' WHEN p % 2 = 0 THEN 'Female' ELSE 'Male' END",
        "age": "CASE WHEN k % 1009 = 7 THEN 'invalid_age' "
               "ELSE format_string('[%d-%d)', p % 10 * 10, p % 10 * 10 + 10) END",
        "weight": "if(k % 30 = 0, '[75-100)', '?')",
        "admission_type_id": "CAST(k % 8 + 1 AS STRING)",
        "discharge_disposition_id": "CAST((k * 7 + p) % 28 + 1 AS STRING)",
        "admission_source_id": "CASE WHEN k % 1013 = 11 THEN 'abc' ELSE CAST((k * 5 + p) % 25 + 1 AS STRING) END",
        "time_in_hospital": "CASE WHEN k % 1019 = 13 THEN '0' WHEN k % 1021 = 17 THEN '15' "
                            "WHEN k % 701 = 3 THEN concat(' ', k % 14 + 1, ' ') ELSE CAST(k % 14 + 1 AS STRING) END",
        "payer_code": pick("k % 5", ("MC", "HM", ""), "?"),
        "medical_specialty": pick("k % 4", ("Cardiology", "InternalMedicine"), "?"),
        "num_lab_procedures": "CASE WHEN k % 1031 = 19 THEN '-1' ELSE CAST((k * 13 + p) % 90 AS STRING) END",
        "num_procedures": "CAST((k + p) % 7 AS STRING)",
        "num_medications": "CASE WHEN k % 1033 <> 23 THEN CAST((k * 3 + p) % 40 + 1 AS STRING) END",
        "number_outpatient": "if((k + p) % 5 = 0, CAST(k % 4 AS STRING), '0')",
        "number_emergency": "if((k + p) % 7 = 0, CAST(k % 3 AS STRING), '0')",
        "number_inpatient": "if((k + p) % 3 = 0, CAST(k % 5 AS STRING), '0')",
        "diag_1": pick("(k * 31 + p) % 16", (
            "250.83", "428", "486", "574", "820", "715.9", "599", "162", "v57", "E909", "785.4", "786", "787", "788",
            "38"), "?"),
        "diag_2": pick("(k * 17 + p) % 8", ("250", "401", "V45", "427.31", " 496 ", "276", "707"), "?"),
        "diag_3": pick("(k * 19 + p) % 8", ("250.02", "414", "v58", "585", "996", "272", ""), "?"),
        "number_diagnoses": "CASE WHEN k % 1039 = 29 THEN '17' ELSE CAST((k * 11 + p) % 16 + 1 AS STRING) END",
        "max_glu_serum": pick("k % 10", ("Norm", ">200", ">300"), "None"),
        "a1c_result": pick("p % 10", ("Norm", ">7", ">8"), "None"),
        "change": "if((k + p) % 2 = 0, 'Ch', 'No')",
        "diabetesmed": "if(k % 4 = 0, 'No', 'Yes')",
        "readmitted": "CASE WHEN k % 1049 = 31 THEN 'UNKNOWN' WHEN (k * 7 + p * 3) % 9 = 0 THEN '<30' "
                      "WHEN (k * 7 + p * 3) % 9 < 4 THEN '>30' ELSE 'NO' END",
    }
    for number, name in enumerate(MEDICATIONS, start=1):
        # two drugs nobody is given
        values[name] = "'No'" if number in (16, 17) else pick(
            f"(k * {number} + p) % 11", ("Steady", "Up", "Down"), "No")
    return src.selectExpr("k * 4 + copy_no AS row_id", *(f"{values[c]} AS {c}" for c in ENCOUNTER_COLUMNS))


def etl_runs(events: DataFrame) -> DataFrame:
    """ETL run history: one run per event."""
    kind = F.col("event_type")
    rows_in = F.col("event_id") % 1000 + 10
    length = F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))
    return events.select(
        F.col("event_id").cast("bigint").alias("id"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("table_"), _text(F.col("user_id") % 5)).alias("target_table"),
        F.col("ts").alias("started_at"),
        F.when(kind != "signup", F.col("ts") + length).alias("finished_at"),
        rows_in.alias("input_rows"),
        F.when(~kind.isin("error", "signup"), rows_in - F.col("event_id") % 7).alias("output_rows"),
        F.when(kind == "error", F.col("props")).alias("error_message"),
    )


def quality_runs(events: DataFrame) -> DataFrame:
    """Quality run history: one run per day of events."""
    bad = (F.col("event_type") == "error").cast("int")
    return events.groupBy(_text(F.col("ts").cast("date")).alias("raw_file_name")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("finished_at"),
        F.count("*").alias("total_rows"),
        F.sum(1 - bad).alias("valid_rows"),
        F.sum(bad).alias("rejected_rows"),
    )


def file_ledger(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Import history: one file per document, fingerprint of its whole text."""
    return documents.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.col("source").alias("source_file_name"),
        F.sha2(F.col("text"), 256).alias("sha256"),
        F.length("text").cast("bigint").alias("file_size_chars"),
        F.when(F.col("quality") == 1, "SUCCESS").when(F.col("quality") == 0, "FAILED").otherwise("NEW").alias("status"),
    )


def scored_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome, predicted class and score per labelled document."""
    score = F.col("n_chars") * 37 % 1000
    return labels.join(documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id",
        F.col("quality").cast("int").alias("y_true"),
        (score >= 500).cast("int").alias("y_pred"),
        (score.cast("double") / 1000).alias("score"),
    )


def legacy_stays(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Legacy stay extract: admission from the order, discharge from its last shipment."""
    discharge = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return orders.join(discharge, "o_orderkey").select(
        k.alias("stay_id"),
        F.when(k % 401 == 3, "n/a").when(k % 419 == 7, F.concat(
            _text(F.col("o_orderdate").cast("date")), F.lit(" 08:30:00"))).otherwise(_text(F.col("o_orderdate").cast("date"))).alias("date_entree"),
        _text(F.col("last_ship").cast("date")).alias("date_sortie"),
        F.when(k % 409 == 5, "inconnu").when(k % 431 == 11, "12d").when(k % 6 == 0, "").otherwise(_text(c % 90 + 5)).alias("age"),
        F.when(k % 8 == 0, "\tOui\n").when(k % 4 == 0, " Oui ").when(k % 4 == 1, "non").when(k % 4 == 2, "NON").alias("diabete"),
        F.when(k % 3 == 0, "h").when(k % 3 == 1, "F ").otherwise("?").alias("sexe"),
        F.when(c % 14 == 2, "\toui").when(c % 2 == 0, "oui").otherwise("non").alias("rehospitalise_30j"),
        F.when(k % 5 != 0, _text(k % 60)).alias("delai_depuis_derniere_hosp_jours"),
    )
