"""File and table readers, sinks and file admission."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ident, literal, null_if_token
from ..plans.warehouse import absent_only
from ..schema import SOURCE_FILE_NAME

# --- readers -----------------------------------------------------------------------------------------------------


def read_csv_text(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Delimited file with a header, every column as text. Declared columns save the header pass."""
    reader = spark.read.option("header", True).option("escape", '"')
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


_WHOLE, _NUMBER = r"^[+-]?[0-9]+\z", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
#: Types a column of text is tried for, narrowest first, and the form their texts have in a file.
INFERRED_TYPES = {
    "int": _WHOLE, "bigint": _WHOLE, "double": _NUMBER, "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.]+)?\z",
    "boolean": r"^(?i:true|false)\z"}
INFERENCE_ROWS = 10_000


def inferred_types(df: DataFrame) -> dict[str, str]:
    """Narrowest type that every non-NULL value of a text column has; ``string`` where none fits or no value is known."""
    if not df.columns:
        return {}
    fits = [(c, t) for c in df.columns for t in INFERRED_TYPES]
    row = df.agg(*(F.count(F.col(ident(c))).alias(f"known{i}") for i, c in enumerate(df.columns)),
                 *(F.count(F.when(F.col(ident(c)).rlike(INFERRED_TYPES[t]), F.col(ident(c)).try_cast(t))).alias(f"fit{i}")
                   for i, (c, t) in enumerate(fits))).first()
    fitting = {pair: row[f"fit{i}"] for i, pair in enumerate(fits)}
    return {c: next((t for t in INFERRED_TYPES if row[f"known{i}"] and fitting[c, t] == row[f"known{i}"]), "string")
            for i, c in enumerate(df.columns)}


def read_csv_inferred(spark: SparkSession, path: str, head: int = INFERENCE_ROWS) -> DataFrame:
    """Delimited file with types inferred from its first ``head`` rows, then read once with those types.

    The head is the only part that reaches the driver. A later value that is not of the inferred type is an error when
    the rows are read, not a NULL. Of several files, the head comes from the one Spark reads first (the largest).
    """
    text = read_csv_text(spark, path)
    first = spark.createDataFrame(text.take(head), text.schema)
    types = inferred_types(first)
    declared = ", ".join(f"{ident(c)} {t}" for c, t in types.items())
    return spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST").schema(declared).csv(path)


def read_csv_null_tokens(spark: SparkSession, path: str, tokens: Iterable[str],
                         types: Mapping[str, str] | None = None) -> DataFrame:
    """Text file in which several tokens mean NULL, then strict types where given."""
    tokens = list(tokens)
    df = read_csv_text(spark, path)
    df = df.select(*(null_if_token(c, tokens).alias(c) for c in df.columns))
    return df.withColumns({c: F.col(c).cast(t) for c, t in (types or {}).items()})


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing row id at read time. Store it with the rows: a second read may number differently."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def count_in_file(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Rows and distinct keys by SQL straight on the stored files."""
    quoted = path.replace("`", "``")
    return spark.sql(
        f"SELECT coalesce(sum(n), 0) AS row_count, count({key}) AS distinct_count "
        f"FROM (SELECT {key}, count(*) AS n FROM parquet.`{quoted}` GROUP BY {key})")


def query(spark: SparkSession, sql: str, **arguments) -> DataFrame:
    """SQL text with named, bound parameters."""
    return spark.sql(sql, args=arguments or None)


# --- sinks -------------------------------------------------------------------------------------------------------


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    df.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def _write_version(df: DataFrame, folder: str, **options: str) -> tuple[str, int]:
    """Write a new version of a table below its folder and reconcile it: the rows that passed into the write against
    those the files hold. Returns its path and its rows."""
    path, passed = f"{folder}/v-{uuid.uuid4().hex}", Observation()
    df.observe(passed, F.count(F.lit(1)).alias("rows")).write.options(**{"compression": "zstd", **options}).parquet(path)
    written, stored = passed.get["rows"], df.sparkSession.read.schema(df.schema).parquet(path).count()
    if stored != written:
        raise ValueError(f"{path}: {written} rows written, {stored} stored")
    return path, stored


def _versions_folder(spark: SparkSession, table: str, path: str | None) -> str:
    return path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}_versions"


def _publish(spark: SparkSession, table: str, schema: T.StructType, version: str) -> None:
    """Let the table point at a version. For an unchanged schema that is one change in the catalog; the version before
    stays on disk for readers that have begun, its place noted in the table."""
    def define(columns: T.StructType, path: str) -> None:
        named = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in columns)
        spark.sql(f"CREATE TABLE {table} ({named}) USING parquet LOCATION {literal(path)}")

    if not spark.catalog.tableExists(table):
        define(schema, version)
        return
    old = spark.table(table).schema
    told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(version)}")
    else:  # another schema needs another definition; only the catalog entry goes, and it comes back if this fails
        if told["type"] != "EXTERNAL":
            raise ValueError(f"{table} is a managed table of another schema: dropping it would delete its rows")
        spark.sql(f"DROP TABLE {table}")
        try:
            define(schema, version)
        except Exception:
            define(old, told["location"])
            raise
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('stayloom.previous' = {literal(told['location'])})")
    spark.catalog.refreshTable(table)


def replace_table(df: DataFrame, table: str, path: str | None = None, **options: str) -> int:
    """Replace a table and reconcile: an empty frame or a differing stored count is an error.

    The rows become a new version below ``path`` (default: beside the warehouse's tables), written and counted before
    the table is pointed at it. A write or a count that fails leaves the old table readable as it was. The frame is
    computed and written once, and it may read the very table it replaces.
    """
    version, stored = _write_version(df, _versions_folder(df.sparkSession, table, path), **options)
    if stored == 0:
        raise ValueError(f"nothing to store in {table}")
    _publish(df.sparkSession, table, df.schema, version)
    return stored


def truncate_insert(df: DataFrame, table: str, path: str | None = None) -> None:
    """Empty an existing table and fill it, as one change: the rows become a new version. Columns are matched by name,
    in the order and the types the table declares. No rows leave an empty table."""
    spark = df.sparkSession
    schema = spark.table(table).schema
    rows = df.select(*(F.col(ident(f.name)).cast(f.dataType).alias(f.name) for f in schema))
    version, _ = _write_version(rows, _versions_folder(spark, table, path))
    _publish(spark, table, schema, version)


def insert_absent(df: DataFrame, table: str, key: str) -> None:
    """Append the rows whose key the table does not hold."""
    stored = df.sparkSession.table(table)
    absent_only(df, stored, key).select(*stored.columns).write.insertInto(table)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A summary table (a row per column or rule) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """CSV files with a header; on request each begins with a byte-order mark, which stands before the first name."""
    if byte_order_mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def json_document(summary: DataFrame, **lists: DataFrame) -> DataFrame:
    """One JSON document: the fields of a one-row summary, plus each small result table as a list of objects."""
    fields = [F.struct(*summary.columns).alias("summary")]
    document = summary.select(*fields)
    for name, rows in lists.items():
        ordered = F.array_sort(F.collect_list(F.struct(*rows.columns)))
        document = document.withColumn(name, rows.agg(ordered.alias("r")).scalar())
    return document.select(F.to_json(F.struct(*document.columns)).alias("document"))


def write_json_report(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)


# --- file admission ----------------------------------------------------------------------------------------------


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and modification time of the files below a folder; content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option(
        "recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")


def given_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Size of the files somebody names; an absent path raises. Spark's listing leaves out empty files, so a named
    file it does not return is empty: size 0."""
    def bare(c):
        return F.regexp_replace(c, "^[A-Za-z0-9+.-]+:(//[^/]*)?", "")

    listed = spark.read.format("binaryFile").load(paths).select(bare("path").alias("_bare"), "length")
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    return named.join(listed, bare("path") == F.col("_bare"), "left").select(
        "path", F.coalesce("length", F.lit(0)).alias("length"))


def newest_file(spark: SparkSession, folder: str, glob: str, explicit: str | None = None) -> str:
    """An explicit path wins; otherwise the newest matching file; an error if there is none."""
    if explicit is not None:
        return explicit
    row = list_files(spark, folder, glob).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    if row["p"] is None:
        raise FileNotFoundError(f"no {glob} in {folder}")
    return row["p"]


CHUNK_BYTES = 1 << 20


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    stores = {}
    for batch in batches:
        digests = []
        for path in batch["path"]:
            # Spark gives paths as they are, not escaped as in a URI: only the store is opened by URI
            root, place = re.match(r"((?:[^/]+://[^/]*)?)/*(.*)", path, re.DOTALL).groups()
            if root not in stores:
                stores[root] = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", f"{root or 'file://'}/"))
            store, base = stores[root]
            digest = hashlib.sha256()
            with store.open_input_stream(f"{base.rstrip('/')}/{place}", compression=None) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 of every file, whatever its size: a task streams its files in pieces of ``CHUNK_BYTES``.

    A hash is sequential by nature, so a file is read by one task; many files run in parallel, dealt by path. Only paths
    and sizes pass between Spark and Python. Empty files are not listed by Spark and have no row. Files are opened by URI with pyarrow, which knows local files, HDFS and the
    usual object stores.
    """
    # Spark lists local files as file:/x, without the empty authority
    listed = list_files(spark, path, glob).select(
        F.regexp_replace("path", "^file:/(?!/)", "file:///").alias("path"), "length")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(parts, "path").mapInPandas(_hash_files, "path string, length bigint, sha256 string")


def admission(files: DataFrame, expected_name: str = SOURCE_FILE_NAME, name="path", size="length") -> DataFrame:
    """Why a file would be refused (NULL = admitted): other name, other extension, or empty."""
    base = F.element_at(F.split(F.col(name), "/"), -1)
    reason = (
        F.when(base != expected_name, "unexpected name")
        .when(~F.lower(base).endswith(".csv"), "unexpected extension")
        .when(F.col(size) == 0, "empty file")
    )
    return files.withColumn("reject_reason", reason)
