"""The layer tables of one input folder, each built once per session and stored as Parquet.

Queries on the warehouse or the marts read the stored layers instead of recomputing the chain from the raw
extract, exactly as separate jobs would. A layer is identified by the application and by a fingerprint of the input
files (path, size, modification time): changed inputs never meet an old layer. The tables lie in the folder
``spark.checkpoint.dir`` names, so they outlive lost executors.

Both encounter facts and the bridge are bucketed on the encounter key: every mart joins them, and with equal
buckets those joins need no shuffle.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.joins import merged
from ..schema import HOSPITAL_RULES
from ..session import shared_folder, tune
from ..sources import inputs, reference_data
from . import chain, clean, features, ml, warehouse

AS_OF = "2024-01-01 00:00:00"  # processing time of the stored layers, fixed so that results can be compared

#: Buckets of the facts. A bucket is read by one task, so a deployment sets it by the size of its tables (some 128 MB a
#: bucket); it is the same for all of them, whatever the input.
BUCKETS = 16

#: Rows of orders for a part of the raw and the curated layer. A task sorts a part of fifty columns in memory (some 1 kB a
#: row), and parts of this size keep all cores busy to the end.
PART_ROWS = 150_000

_trained: dict[tuple[str, str, str], tuple[str, str]] = {}
_chains: dict[tuple[str, str, str], str] = {}
_stored: dict[tuple[str, str, str], Callable[[SparkSession], DataFrame]] = {}


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Identity of the files below a path; only the listing is read, never the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(F.xxhash64("path", "modificationTime", "length")), F.lit(0)).alias("mix"),
    ).first()
    return f"{row['files']}-{row['bytes']}-{row['mix'] & (2**64 - 1):016x}"


class Layers:
    """Raw, valid, curated, features, dimensions and facts of one folder of input tables."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = tune(spark), folder, buckets
        self.rules = HOSPITAL_RULES

    @cached_property
    def _source(self) -> str:
        return input_fingerprint(self.spark, f"{self.folder}/orders.parquet")

    @cached_property
    def parts(self) -> int:
        """Parts of the raw and the curated layer: at least one a bucket, and no more rows in them as the input grows."""
        return max(self.buckets, math.ceil(self.input("orders").count() / PART_ROWS))  # counted from the footers

    @property
    def _key(self) -> tuple[str, str]:
        return self.spark.sparkContext.applicationId, f"{self._source}-{self.buckets}"

    def input(self, name: str) -> DataFrame:
        return inputs.table(self.spark, self.folder, name)

    def _layer(self, name: str, build: Callable[[], DataFrame], bucket: str | None = None) -> DataFrame:
        key = (*self._key, name)
        if key not in _stored:
            df, tag = build(), uuid.uuid4().hex
            path = f"{shared_folder(self.spark)}/layers/{name}-{tag}"
            if bucket is None:
                df.write.option("compression", "zstd").parquet(path)
                schema = df.schema
                _stored[key] = lambda spark: spark.read.schema(schema).parquet(path)
            else:
                table = f"stayloom_{name}_{tag}"
                (df.repartition(self.buckets, bucket).write.option("compression", "zstd").option("path", path)
                 .bucketBy(self.buckets, bucket).sortBy(bucket).saveAsTable(table))
                _stored[key] = lambda spark: spark.table(table)
        return _stored[key](self.spark)

    def raw_lazy(self) -> DataFrame:
        return inputs.raw_encounters(self.input("orders").select("o_orderkey", "o_custkey"))

    def raw_dealt(self) -> DataFrame:
        """Dealt by key over parts of some rows each, so that scans of it do not depend on the files it came in. The two
        columns it is made of are shuffled, not the fifty it has."""
        orders = self.input("orders").select("o_orderkey", "o_custkey")
        return inputs.raw_encounters(orders.repartition(self.parts, "o_orderkey"))

    def raw(self) -> DataFrame:
        return self._layer("raw", self.raw_dealt)

    def violations(self) -> DataFrame:
        return self._layer("violations", lambda: quality.violations(self.raw(), self.rules, as_of=AS_OF))

    def valid(self) -> DataFrame:
        return self._layer("valid", lambda: quality.valid_rows(self.raw(), self.rules))

    def curated(self) -> DataFrame:
        return self._layer("curated", lambda: clean.sorted_by_key(
            clean.curated(self.valid(), as_of=AS_OF), self.valid(), self.parts))

    def features(self) -> DataFrame:
        return self._layer("features", lambda: features.features(self.curated()))

    def encounters(self) -> DataFrame:
        """Curated and feature columns together, row by row."""
        return features.with_features(self.curated())

    def reference(self) -> dict[str, DataFrame]:
        return reference_data.code_dimensions(self.spark)

    def dim_patient(self) -> DataFrame:
        return self._layer("dim_patient", lambda: warehouse.dim_patient(self.encounters()))

    def dim_diagnosis(self) -> DataFrame:
        return self._layer("dim_diagnosis", lambda: warehouse.dim_diagnosis(self.curated()))

    def dim_medication(self) -> DataFrame:
        return warehouse.dim_medication(self.spark)

    def dim_date(self) -> DataFrame:
        return warehouse.dim_date(self.spark)

    def fact_hospitalization(self) -> DataFrame:
        return self._layer("fact_hospitalization", lambda: warehouse.fact_hospitalization(
            self.encounters(), self.dim_patient(), self.dim_diagnosis()), bucket="encounter_key")

    def fact_readmission(self) -> DataFrame:
        return self._layer("fact_readmission", lambda: warehouse.fact_readmission(self.encounters()),
                           bucket="encounter_key")

    def fact_medication_usage(self) -> DataFrame:
        return self._layer("fact_medication_usage", lambda: warehouse.fact_medication_usage(
            self.curated()), bucket="encounter_key")

    def chain(self) -> str:
        """Folder of a whole run over the raw extract, with manifest and histories; run once per session and input."""
        key = (*self._key, "chain")
        if key not in _chains:
            folder = f"{shared_folder(self.spark)}/chains/{uuid.uuid4().hex}"
            chain.run_chain(self.spark, self.raw_dealt(), folder, self.reference(), content_hash=self._source,
                            as_of=AS_OF, buckets=self.buckets)
            _chains[key] = folder
        return _chains[key]

    def model_split(self) -> DataFrame:
        """Model rows with their side of the split: every fit reads the table several times."""
        def build():
            rows = ml.model_rows(self.encounters())
            side = ml.stratified_split(rows, "encounter_id", ml.MODEL_TARGET).select("encounter_id", "is_test")
            return rows.join(merged(side), "encounter_id")

        return self._layer("model_split", build)

    def train_and_test(self) -> tuple[DataFrame, DataFrame]:
        both = self.model_split()
        return both.filter("is_test = 0").drop("is_test"), both.filter("is_test = 1").drop("is_test")

    def trained(self) -> tuple[str, str]:
        """Folder of the stored models and the name of the best one; trained once per session and input."""
        key = (*self._key, "models")
        if key not in _trained:
            folder = f"{shared_folder(self.spark)}/models/{uuid.uuid4().hex}"
            _trained[key] = folder, ml.train_and_store(*self.train_and_test(), folder)[0]
        return _trained[key]
