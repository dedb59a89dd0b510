"""The whole chain, each step gated on the one before: ingest → validate → clean → features → warehouse → marts.

Every layer is written before the next step starts, so a lost executor costs a task and a failed step costs that
step only. Two kinds of record lie beside the layers:

* the *manifest*, one entry per step with the fingerprint of what the step read and of what it wrote. A step whose
  input has not changed and whose output is still there is not run again, so a run that failed or was killed resumes at
  the first step it did not finish;
* the *histories* of pipeline, import, quality and ETL runs and of rule results (``operators/ledger.py``). A run that
  was killed is taken up under its own id, and its events replace those it had told; a run that failed stays in the
  history, and its successor gets an id of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import error_text, ident
from ..operators import ledger, quality
from ..schema import ENCOUNTER_COLUMNS, FLAG_COLUMNS, HOSPITAL_RULES, SOURCE_FILE_NAME
from ..session import tune
from ..sources import files
from . import clean, features, marts, warehouse

STEPS = ("ingestion", "validation", "etl", "feature_engineering", "data_warehouse", "data_marts")

#: Tables of the warehouse that share the encounter key, bucketed alike so that marts join them without a shuffle.
FACTS = ("fact_hospitalization", "fact_readmission", "fact_medication_usage")
DIMENSIONS = ("dim_patient", "dim_diagnosis", "dim_medication", "dim_date")

#: What each step leaves behind; its fingerprint covers these folders, and the next steps build on it.
OUTPUTS = {
    "ingestion": ("raw",), "validation": ("quarantine", "clean"), "etl": ("curated",),
    "feature_engineering": ("features",), "data_warehouse": ("warehouse",), "data_marts": (),
}

RULE_RESULTS = "rule_name string, column_name string, description string, violation_count bigint, run_id string"
MANIFEST = "run_id string, read string, wrote string, rows bigint, finished_at timestamp, step string"
QUALITY_DETAILS = {
    "raw_file_name": "string", "total_rows": "bigint", "valid_rows": "bigint", "rejected_rows": "bigint",
    "total_violations": "bigint", "duplicate_rows": "bigint", "valid_path": "string", "quarantine_path": "string",
    "report_path": "string", "error_message": "string"}
ETL_DETAILS = {
    "target_table": "string", "source_path": "string", "curated_path": "string", "input_rows": "bigint",
    "output_rows": "bigint", "duplicates_removed": "bigint", "source_columns": "int", "output_columns": "int",
    "stored_rows": "bigint", "error_message": "string"}
IMPORT_DETAILS = {"source_file_name": "string", "sha256": "string", "raw_path": "string", "rows": "bigint",
                  "error_message": "string"}
PIPELINE_DETAILS = {"source_file": "string", "source": "string", "sha256": "string", "error_message": "string"}


class StoredStar:
    """Dimensions and facts read from the folder of a finished chain.

    The facts were written as buckets. Their definition is registered again in a session that does not know it, so the
    joins of the marts find them co-located there, too.
    """

    def __init__(self, spark: SparkSession, folder: str, reference: dict[str, DataFrame]):
        self._spark, self._folder, self._reference = spark, folder, reference

    def _read(self, name):
        return self._spark.read.parquet(f"{self._folder}/warehouse/{name}")

    def _fact(self, name):
        table = _table(self._folder, name)
        if not self._spark.catalog.tableExists(table):
            path = f"{self._folder}/warehouse/{name}"
            columns = ", ".join(f"{ident(c)} {t}" for c, t in self._spark.read.parquet(path).dtypes)
            buckets = self._spark.read.parquet(f"{self._folder}/warehouse/buckets").first()["buckets"]
            self._spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (encounter_key) SORTED BY (encounter_key) "
                f"INTO {buckets} BUCKETS LOCATION :path", args={"path": path})
        return self._spark.table(table)

    def dim_patient(self):
        return self._read("dim_patient")

    def dim_diagnosis(self):
        return self._read("dim_diagnosis")

    def dim_medication(self):
        return self._read("dim_medication")

    def fact_hospitalization(self):
        return self._fact("fact_hospitalization")

    def fact_readmission(self):
        return self._fact("fact_readmission")

    def fact_medication_usage(self):
        return self._fact("fact_medication_usage")

    def reference(self):
        return self._reference


def _table(folder: str, name: str) -> str:
    """Name of a fact in the catalog: one per folder."""
    return f"stayloom_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def rows_fingerprint(rows: DataFrame) -> str:
    """Identity of a table by content, whatever the order of its rows or files: one scan, one row to the driver.

    Two independent 64-bit hashes of each row are summed, so repeated rows count as often as they stand there.
    """
    # sums of 64-bit hashes as decimals do not overflow
    def total(value):
        return F.coalesce(F.sum(value.cast("decimal(20,0)")), F.lit(0)).cast("string")

    columns = [F.col(ident(c)) for c in rows.columns]
    one = rows.agg(F.count("*").cast("string").alias("n"), total(F.xxhash64(*columns)).alias("a"),
                   total(F.xxhash64(F.lit("second"), *columns)).alias("b")).first()
    text = "|".join([",".join(rows.columns), one["n"], one["a"], one["b"]])
    return hashlib.sha256(text.encode()).hexdigest()


def run_chain(spark: SparkSession, source: DataFrame, out: str, reference: dict[str, DataFrame],
              source_file: str = SOURCE_FILE_NAME, content_hash: str | None = None,
              as_of: str | None = None, buckets: int = 16) -> dict[str, str]:
    """Run all steps over a raw extract with ``row_id`` and write every layer below ``out``.

    Returns the status of each step: SUCCESS, REUSED for a step whose stored output stands for the same input, or
    SKIPPED throughout for content (``content_hash``) that a successful run has imported before. Without a hash the
    source is identified by its rows, which costs one scan; a repeated run then reuses what is stored. ``as_of`` fixes
    the processing time of the rows, ``buckets`` is the number of buckets of every fact. The raw layer is written in the
    partitions of the source, so a source in few large files is dealt by the caller. One run at a time may write to a
    folder.
    """
    tune(spark)
    store = ledger.EventStore(spark, f"{out}/history")
    if content_hash and _imported_before(store, content_hash):
        return dict.fromkeys(STEPS, "SKIPPED")
    given = content_hash or rows_fingerprint(source)
    identity = hashlib.sha256("|".join([given, source_file, str(as_of), str(buckets)]).encode()).hexdigest()
    run_id = _unfinished(store, identity) or uuid.uuid4().hex
    status: dict[str, str] = {}

    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    def write_fact(df: DataFrame, name: str) -> None:
        table = _table(out, name)
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: the definition goes, files are overwritten
        (df.repartition(buckets, "encounter_key").write.mode("overwrite").option("compression", "zstd")
         .option("path", f"{out}/warehouse/{name}").bucketBy(buckets, "encounter_key").sortBy("encounter_key")
         .saveAsTable(table))

    def ingest():
        named = clean.normalize_names(source)
        quality.require_columns(named, ("row_id", *ENCOUNTER_COLUMNS))
        stored = write(named, "raw")
        quality.raise_on_failure(quality.not_empty(stored))
        return stored.agg(F.count("*").alias("rows"))

    def validate():
        raw = spark.read.parquet(f"{out}/raw")
        found = write(quality.quarantine(raw, HOSPITAL_RULES, as_of=as_of), "quarantine")
        write(quality.valid_rows(raw, HOSPITAL_RULES), "clean")
        summary = quality.violation_summary(found)
        missing = quality.missing_summary(raw, ENCOUNTER_COLUMNS)
        totals = write(quality.run_totals(raw, found), "reports/quality_totals")  # counted once, read four times
        files.write_csv_report(summary, f"{out}/reports/violations")
        files.write_csv_report(missing, f"{out}/reports/missing_values")
        files.write_json_report(files.json_document(totals, violations=summary, missing_values=missing),
                                f"{out}/reports/quality")
        store.put("rule_results", summary.select("rule_name", "column_name", F.col("rejection_reason").alias(
            "description"), "violation_count"), run_id=run_id)
        return totals.drop("valid_rate_percent").withColumn("rows", F.col("valid_rows"))

    def transform():
        valid = spark.read.parquet(f"{out}/clean")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        curated = write(clean.sorted_by_key(clean.curated(valid, source_file, as_of), valid, parts), "curated")
        quality.raise_on_failure(quality.curated_checks(curated, "encounter_id", clean.INTEGER_COLUMNS))
        counted = clean.clean_statistics(valid, curated).drop("null_values_before", "null_values_after")
        stored = files.count_in_file(spark, f"{out}/curated", "encounter_id").select("row_count").scalar()
        return counted.withColumn("stored_rows", stored).withColumn("rows", F.col("output_rows"))

    def engineer():
        table = write(features.features(spark.read.parquet(f"{out}/curated")), "features")
        quality.raise_on_failure(quality.feature_checks(table, "encounter_id", FLAG_COLUMNS))
        return table.agg(F.count("*").alias("rows"))

    def build():
        curated = spark.read.parquet(f"{out}/curated")
        encounters = features.with_features(curated)
        write(warehouse.dim_medication(spark), "warehouse/dim_medication")
        patients = write(warehouse.dim_patient(encounters), "warehouse/dim_patient")
        diagnoses = write(warehouse.dim_diagnosis(curated), "warehouse/dim_diagnosis")
        write(warehouse.dim_date(spark), "warehouse/dim_date")
        for name, df in reference.items():
            write(df, f"warehouse/{name}")
        write(spark.range(1).select(F.lit(buckets).alias("buckets")), "warehouse/buckets")
        write_fact(warehouse.fact_hospitalization(encounters, patients, diagnoses), "fact_hospitalization")
        write_fact(warehouse.fact_readmission(encounters), "fact_readmission")
        write_fact(warehouse.fact_medication_usage(curated), "fact_medication_usage")
        return StoredStar(spark, out, reference).fact_hospitalization().agg(F.count("*").alias("rows"))

    def publish():
        star = StoredStar(spark, out, reference)
        marts.create_views(star)
        counts = warehouse.table_counts({"mart": spark.table("mart_readmission"), "fact": star.fact_hospitalization()})
        different = counts.agg((F.max("row_count") - F.min("row_count")).alias("mart_grain"))
        quality.raise_on_failure(quality.check_rows(different))
        return spark.table("mart_readmission").agg(F.count("*").alias("rows"))

    opening = {
        "ingestion": ("import", {"source_file_name": source_file, "sha256": content_hash, "raw_path": f"{out}/raw"}),
        "validation": ("quality", {
            "raw_file_name": source_file, "valid_path": f"{out}/clean", "quarantine_path": f"{out}/quarantine",
            "report_path": f"{out}/reports/quality"}),
        "etl": ("etl", {"target_table": "curated", "source_path": f"{out}/clean", "curated_path": f"{out}/curated"}),
    }
    actions: dict[str, Callable[[], DataFrame]] = dict(
        zip(STEPS, (ingest, validate, transform, engineer, build, publish)))
    store.tell("pipeline", run_id, "opened", "RUNNING", {
        "source_file": source_file, "source": identity, "sha256": content_hash})
    step = STEPS[0]
    try:
        read = identity
        done = {r["step"]: r for r in store.read("manifest", MANIFEST).collect()}  # one row per step
        for step, action in actions.items():
            entry = done.get(step)
            if OUTPUTS[step] and entry and entry["read"] == read and entry["wrote"] == _fingerprint(spark, out, step):
                status[step] = "REUSED"
                read = entry["wrote"]
                continue
            kind, known = opening.get(step, (None, {}))
            if kind:
                store.tell(kind, run_id, "opened", "RUNNING", known)
            result = action().first()  # counts of the step, one row
            if kind:
                told = {name: value for name, value in result.asDict().items() if name != "rows" or kind == "import"}
                store.tell(kind, run_id, "closed", "SUCCESS", told)
            wrote = _fingerprint(spark, out, step) if OUTPUTS[step] else read
            store.put("manifest", spark.range(1).select(
                F.lit(run_id).alias("run_id"), F.lit(read).alias("read"), F.lit(wrote).alias("wrote"),
                F.lit(result["rows"]).cast("bigint").alias("rows"), F.current_timestamp().alias("finished_at")), step=step)
            read, status[step] = wrote, "SUCCESS"
    except Exception as error:
        message = {"error_message": str(error)[:4000], "failed_step": step}
        if step in opening:
            store.tell(opening[step][0], run_id, "closed", "FAILED", message)
        store.tell("pipeline", run_id, "closed", "FAILED", message)
        raise
    store.tell("pipeline", run_id, "closed", "SUCCESS", {"sha256": content_hash})
    return status


def _fingerprint(spark: SparkSession, out: str, step: str) -> str:
    """What a step has written: names, sizes and times of its files. Only finished writes count (``_SUCCESS``)."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    told = [step]
    for name in OUTPUTS[step]:
        path = f"{out}/{name}"
        for folder in ([path] if name != "warehouse" else [f"{path}/{t}" for t in (*DIMENSIONS, *FACTS)]):
            if not _exists(spark, f"{folder}/_SUCCESS"):
                return "unfinished"
        row = read.load(path).agg(
            F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.coalesce(F.bit_xor(F.xxhash64("path", "modificationTime", "length")), F.lit(0)).alias("mix")).first()
        told.append(f"{name}:{row['n']}-{row['bytes']}-{row['mix']}")
    return hashlib.sha256("|".join(told).encode()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def _unfinished(store: ledger.EventStore, identity: str) -> str | None:
    """Id of the newest run over the same source that was opened and never closed: its driver was killed."""
    last = store.runs("pipeline", PIPELINE_DETAILS).filter(
        (F.col("status") == "RUNNING") & (F.col("source") == identity)).agg(F.max_by("run_id", "started_at").alias("id"))
    return last.first()["id"]


def _imported_before(store: ledger.EventStore, content_hash: str) -> bool:
    runs = store.runs("pipeline", PIPELINE_DETAILS)
    return not runs.filter((F.col("status") == "SUCCESS") & (F.col("sha256") == content_hash)).isEmpty()


# --- what a folder tells about its runs ----------------------------------------------------------------------------


def run_history(spark: SparkSession, out: str) -> DataFrame:
    """Current state of every pipeline run of an output folder."""
    state = ledger.EventStore(spark, f"{out}/history").runs("pipeline", PIPELINE_DETAILS)
    return state.withColumn("error_message", error_text("error_message"))


def quality_history(spark: SparkSession, out: str) -> DataFrame:
    """Quality runs, as ``marts.mart_quality`` takes them."""
    return ledger.EventStore(spark, f"{out}/history").runs("quality", QUALITY_DETAILS).withColumnRenamed(
        "run_id", "quality_run_id")


def etl_history(spark: SparkSession, out: str) -> DataFrame:
    return ledger.EventStore(spark, f"{out}/history").runs("etl", ETL_DETAILS).withColumnRenamed("run_id", "id")


def import_history(spark: SparkSession, out: str) -> DataFrame:
    return ledger.EventStore(spark, f"{out}/history").runs("import", IMPORT_DETAILS).withColumnRenamed("run_id", "id")


def rule_history(spark: SparkSession, out: str) -> DataFrame:
    """Violations per rule of every successful quality run, as ``marts.mart_quality_violations`` takes them."""
    told = ledger.EventStore(spark, f"{out}/history").read("rule_results", RULE_RESULTS)
    done = quality_history(spark, out).filter("status = 'SUCCESS' AND total_violations > 0").select("quality_run_id")
    return told.withColumnRenamed("run_id", "quality_run_id").join(done, "quality_run_id", "left_semi")


def chain_status(spark: SparkSession, out: str) -> DataFrame:
    """Step by step status and rows, from the manifest and the newest run. The step at which the newest run stopped is
    FAILED; those behind it and those without an entry are PENDING."""
    store = ledger.EventStore(spark, f"{out}/history")
    steps = spark.createDataFrame(list(enumerate(STEPS, start=1)), "position int, step string")
    entries = store.read("manifest", MANIFEST).select("step", "run_id", "rows")
    runs = store.runs("pipeline", PIPELINE_DETAILS | {"failed_step": "string"})
    stopped = runs.agg(F.max_by("failed_step", "started_at").alias("s")).join(
        steps, F.col("s") == F.col("step")).select("position").scalar()
    status = (F.when(F.col("position") == stopped, "FAILED").when(F.col("position") > stopped, "PENDING")
              .when(F.col("rows").isNotNull(), "SUCCESS").otherwise("PENDING"))
    return steps.join(F.broadcast(entries), "step", "left").select("position", "step", status.alias("status"), "rows")
