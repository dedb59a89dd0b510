"""Run ledgers as event tables, and the rule that known content is not imported again.

A run is opened with a RUNNING event and closed with SUCCESS (and counts) or FAILED (and a message). Events are never
changed: the current state of a run is its last event.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import error_text

EVENT_COLUMNS = ("run_id", "status", "at", "details")


class EventStore:
    """Event tables of a folder, stored as Parquet and partitioned by what identifies an event.

    A write replaces exactly the partition it names, so a step that is repeated after a crash overwrites its event and
    cannot append it twice. Values of partitions are given by the caller, not by the rows. Rows that were stored and
    are empty when repeated leave the older ones in place, so a table of results is read together with its event.
    """

    EVENTS = "status string, at timestamp, details map<string,string>, ledger string, run_id string, event string"

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def put(self, table: str, rows: DataFrame, **partition: str) -> None:
        """Store the rows as the whole content of one partition."""
        named = rows.withColumns({name: F.lit(value) for name, value in partition.items()})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(
            f"{self._folder}/{table}")

    def read(self, table: str, schema: str) -> DataFrame:
        """A table of the store, empty where nothing was stored yet. The declared types keep run ids text."""
        path = f"{self._folder}/{table}"
        jvm_path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jvm_path)
        return self._spark.read.schema(schema).parquet(path)

    def tell(self, ledger: str, run_id: str, event: str, status: str, details: Mapping[str, object] | DataFrame) -> None:
        """Store one event. Details are values, or a frame of one row whose columns name them; NULL is left out."""
        if not isinstance(details, DataFrame):
            known = {name: str(value) for name, value in details.items() if value is not None}
            details = self._spark.range(1).select(*(F.lit(v).alias(n) for n, v in known.items()))
        self.put("events", details.select(
            F.lit(status).alias("status"), F.current_timestamp().alias("at"), _details(details.columns).alias("details")),
            ledger=ledger, run_id=run_id, event=event)

    def events(self, ledger: str) -> DataFrame:
        return self.read("events", self.EVENTS).filter(F.col("ledger") == ledger).select(*EVENT_COLUMNS)

    def runs(self, ledger: str, types: Mapping[str, str]) -> DataFrame:
        """Current state of the runs of a ledger, the named details as columns of the given types."""
        state = current_state(self.events(ledger))
        return state.select(
            "run_id", "status", "started_at", "finished_at",
            *(F.col("details")[name].cast(kind).alias(name) for name, kind in types.items()))


def opened(runs: DataFrame, run_id: str, at: str, details: Sequence[str]) -> DataFrame:
    """RUNNING events. Details are kept as a map of texts, so every ledger has the same four columns."""
    return _events(runs, run_id, F.lit("RUNNING"), at, details)


def closed(runs: DataFrame, run_id: str, status: str, at: str, details: Sequence[str]) -> DataFrame:
    """Closing events of finished runs."""
    return _events(runs.filter(F.col(status).isin("SUCCESS", "FAILED")), run_id, F.col(status), at, details)


def _events(runs, run_id, status, at, details):
    return runs.select(F.col(run_id).alias("run_id"), status.alias("status"), F.col(at).alias("at"),
                       _details(details).alias("details"))


def _details(columns):
    if not columns:
        return F.create_map().cast("map<string,string>")
    pairs = F.create_map(*(part for c in columns for part in (F.lit(c), error_text(F.col(c).cast("string")))))
    return F.map_filter(pairs, lambda _, value: value.isNotNull())


def current_state(events: DataFrame) -> DataFrame:
    """Last event per run, with the time of the first. A closing event beats an opening one of the same time. Details
    of all events of the run are kept, later ones winning."""
    order = F.struct("at", (F.col("status") != "RUNNING").alias("closing"))
    last = events.groupBy("run_id").agg(
        F.min("at").alias("started_at"), F.max_by(F.struct("status", "at"), order).alias("last"),
        F.array_sort(F.collect_list(F.struct(order.alias("order"), "details")), lambda a, b: F.when(
            a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0)).alias("told"))  # two events
    merged = F.aggregate(
        "told", F.create_map().cast("map<string,string>"),
        lambda known, event: F.map_concat(F.map_filter(known, lambda k, _: ~F.map_contains_key(
            event["details"], k)), event["details"]))
    return last.select(
        "run_id", F.col("last.status").alias("status"), "started_at",
        F.when(F.col("last.status") != "RUNNING", F.col("last.at")).alias("finished_at"),
        merged.alias("details"))


def import_decisions(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """``SKIPPED`` for content that was imported before (newest successful import is named), else ``IMPORT``.

    Both tables have ``id`` and ``sha256``; of equal files in one batch only the first is imported. Hashes are
    reduced to one row each before they meet the files, so a hash shared by very many files is no hot spot.
    """
    before = ledger.filter(F.col("status") == "SUCCESS").groupBy("sha256").agg(F.max("id").alias("imported_id"))
    first = incoming.groupBy("sha256").agg(F.min("id").alias("first_id"))
    known = first.join(before, "sha256", "left")
    previous = F.coalesce("imported_id", F.when(F.col("id") != F.col("first_id"), F.col("first_id")))
    return incoming.join(known, "sha256").select(
        *incoming.columns, previous.alias("previous_import_id"),
        F.when(previous.isNull(), "IMPORT").otherwise("SKIPPED").alias("decision"))


def to_import(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Only the files whose content no successful import has seen, and of equal files of one batch only the first."""
    return import_decisions(incoming, ledger).filter("decision = 'IMPORT'").select(*incoming.columns)
