"""Valid rows → curated table: missing tokens, keep-first, strict types, fills, code case, names, audit columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_if_missing, strip, strip_sql
from ..operators.order import keep_first
from ..operators.quality import require_columns
from ..schema import (ALLOWED_VALUES, DIAGNOSES, ENCOUNTER_COLUMNS, ETL_VERSION, FILL_UNKNOWN, MEDICATIONS, NUMERIC_BOUNDS,
                      SOURCE_FILE_NAME, SOURCE_NAMES, UNKNOWN)

INTEGER_COLUMNS = tuple(NUMERIC_BOUNDS)
AUDIT_COLUMNS = ("etl_processed_at", "etl_source_file", "etl_version")


def normalize_names(df: DataFrame) -> DataFrame:
    """Published header names → snake_case; names already in that form stay."""
    return df.withColumnsRenamed({source: name for name, source in SOURCE_NAMES.items()})


def blank_missing(df: DataFrame) -> DataFrame:
    """Strip every declared text column and turn missing tokens into NULL."""
    return df.withColumns({c: null_if_missing(c, ALLOWED_VALUES.get(c, ())) for c in ENCOUNTER_COLUMNS})


def cast_integers(df: DataFrame) -> DataFrame:
    """Strict: a value that is not an integer stops the job (ANSI cast)."""
    return df.withColumns({c: F.expr(f"CAST({c} AS BIGINT)") for c in INTEGER_COLUMNS})


def fill_unknown(df: DataFrame) -> DataFrame:
    """Descriptive columns get a label; diagnoses stay NULL."""
    return df.na.fill(UNKNOWN, list(FILL_UNKNOWN))


def upper_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.expr(f"upper({strip_sql(c)})") for c in DIAGNOSES})


def strip_medications(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip(c) for c in MEDICATIONS})


def add_audit(df: DataFrame, source_file: str = SOURCE_FILE_NAME, as_of: str | None = None) -> DataFrame:
    at = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return df.withColumns(dict(zip(AUDIT_COLUMNS, (at, F.lit(source_file), F.lit(ETL_VERSION)))))


def curated(valid: DataFrame, source_file: str = SOURCE_FILE_NAME, as_of: str | None = None) -> DataFrame:
    """The clean step. ``valid`` carries ``row_id``, which decides what "first" means for repeated keys."""
    named = normalize_names(valid)
    require_columns(named, ("row_id", *ENCOUNTER_COLUMNS))
    first = keep_first(blank_missing(named.select("row_id", *ENCOUNTER_COLUMNS)), "encounter_id")
    typed = strip_medications(upper_codes(fill_unknown(cast_integers(first))))
    return add_audit(typed, source_file, as_of).select(*ENCOUNTER_COLUMNS, *AUDIT_COLUMNS)


def sorted_by_key(df: DataFrame, source: DataFrame, parts: int, key: str = "encounter_id") -> DataFrame:
    """Total order for writing: ``parts`` ranges of the key, sorted inside; also clusters the files for key lookups.

    The bounds come from the key column of ``source``, the table that ``df`` is made of. Spark's own range partitioning
    would sample ``df`` in a pass of its own, and run the clean step twice or need it written twice.
    """
    if parts < 2:
        return df.coalesce(1).sortWithinPartitions(key)
    shares = [k / parts for k in range(1, parts)]
    number = F.expr(f"try_cast({strip_sql(key)} AS BIGINT)")
    bounds = source.agg(F.percentile_approx(number, shares, 20 * parts).alias("b")).first()["b"] or []  # parts - 1 numbers
    before = _bounds_below(sorted(set(bounds)), key)
    return df.repartitionById(parts, F.coalesce(before, F.lit(0)).cast("int")).sortWithinPartitions(key)


def _bounds_below(bounds: list[int], key: str) -> Column:
    """How many of the sorted bounds lie below the key: every step-th one is compared, then those of one step, so that a
    row costs twice the square root of their number."""
    def below(some):
        return F.size(F.filter(some, lambda bound: bound < F.col(key)))

    step = math.isqrt(len(bounds)) + 1
    passed = below(F.lit(bounds[step - 1::step]).cast("array<bigint>")) * step
    return passed + below(F.slice(F.lit(bounds).cast("array<bigint>"), passed + 1, F.lit(step)))


def null_cells(columns) -> Column:
    known = ", ".join(f"CAST({c} IS NULL AS BIGINT)" for c in columns)
    return F.expr(f"coalesce(sum(aggregate(array({known}), 0L, (n, x) -> n + x)), 0L)")


def clean_statistics(valid: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows in and out, duplicates removed, columns, NULL cells before and after."""
    before = valid.agg(F.count("*").alias("input_rows"), null_cells(ENCOUNTER_COLUMNS).alias("null_values_before"))
    after = cleaned.agg(F.count("*").alias("n"), null_cells(cleaned.columns).alias("nulls"))
    out = after.select(F.struct("n", "nulls").alias("s")).scalar()
    return before.withColumn("_after", out).select(
        "input_rows",
        F.col("_after.n").alias("output_rows"),
        (F.col("input_rows") - F.col("_after.n")).alias("duplicates_removed"),
        F.lit(len(ENCOUNTER_COLUMNS)).alias("source_columns"),
        F.lit(len(cleaned.columns)).alias("output_columns"),
        "null_values_before",
        F.col("_after.nulls").alias("null_values_after"),
    )
