"""Profiling of any table: completeness, distinct values, distributions, descriptive statistics.

Per-column questions are asked in long form, ``(column, value)``, so that one scan answers them for all columns and
the work is a keyed aggregation with map-side partial counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import half_up, percent, ratio
from ..functions.text import ident, literal
from ..schema import SEVERITY_BANDS
from .order import repeated_keys
from .quality import column_types, long_counts
from .reshape import melt
from .selection import select_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def long_form(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value)`` with every value as text."""
    return melt(df, [], list(columns or df.columns), "column_name", "value")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column; NULL counts as a value."""
    return long_form(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("n")).groupBy(
        "column_name").agg(F.count("*").alias("unique_count"))


def constant_columns(df: DataFrame) -> DataFrame:
    return distinct_counts(df).filter("unique_count <= 1")


def null_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column with share and severity."""
    columns = list(columns or df.columns)
    counts = long_counts(df, {c: f"{ident(c)} IS NULL" for c in columns}, "null_count")
    rated = counts.select("column_name", "null_count",
                          percent(F.col("null_count"), F.col("total_rows"), 2).alias("null_percentage"))
    return rated.withColumn("severity", severity("null_percentage")).orderBy(
        F.desc("null_percentage"), "column_name")


def severity(percentage: str) -> Column:
    """Band of a missing share: none, below 5, below 20, below 50, the rest."""
    p = F.col(percentage)
    none, low, moderate, high, critical = SEVERITY_BANDS
    return F.when(p == 0, none).when(p < 5, low).when(p < 20, moderate).when(p < 50, high).otherwise(critical)


def mostly_missing(summary: DataFrame, at_least: float = 40.0) -> DataFrame:
    return summary.filter(F.col("null_percentage") >= at_least)


def token_summary(df: DataFrame, token: str = "?") -> DataFrame:
    """Cells of the text columns that equal a token; columns without any are left out."""
    counts = long_counts(df, {c: f"{ident(c)} = {literal(token)}" for c in text_columns(df)}, "question_mark_count")
    return counts.filter("question_mark_count > 0").select(
        "column_name", "question_mark_count",
        percent(F.col("question_mark_count"), F.col("total_rows"), 2).alias("percentage"),
    ).orderBy(F.desc("percentage"), "column_name")


def quality_summary(df: DataFrame) -> DataFrame:
    """Type, NULLs, distinct values and NULL share of every column, all from one count per (column, value)."""
    per_value = long_form(df).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    per_column = per_value.groupBy("column_name").agg(
        F.coalesce(F.sum(F.expr("CASE WHEN value IS NULL THEN n END")), F.lit(0)).alias("null_count"),
        F.count("*").alias("unique_count"), F.sum("n").alias("total_rows"))
    return column_types(df).join(per_column, "column_name", "left").select(
        "column_name", "data_type", F.coalesce("null_count", F.lit(0)).alias("null_count"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        percent(F.coalesce("null_count", F.lit(0)), F.coalesce("total_rows", F.lit(0)), 2).alias("null_percentage"),
    ).orderBy(F.desc("null_percentage"), "column_name")


def category_summary(df: DataFrame, column: str, limit: int | None = 20) -> DataFrame:
    """Values of a column by frequency, with their share of all rows."""
    total = df.agg(F.count("*").alias("n")).scalar()
    out = df.groupBy(column).agg(F.count("*").alias("count")).withColumn(
        "percentage", percent(F.col("count"), total, 2)).orderBy(F.desc("count"), F.asc_nulls_first(column))
    return out if limit is None else out.limit(limit)


def category_summaries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for several columns in one pass: ``(column_name, value, count, percentage)``."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return long_form(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("count")).withColumn(
        "percentage", percent(F.col("count"), total, 2))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows after the first copy of each distinct row.

    A hash of the row goes first: only rows whose hash is repeated are compared in full, and only they are shuffled.
    """
    probe = df.withColumn("_probe", F.xxhash64(*df.columns))
    again = repeated_keys(probe, "_probe").select(F.col("_probe").alias("_again"))
    candidates = probe.join(again, F.col("_probe") == F.col("_again"), "left_semi")
    return candidates.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_row_count"))


def repeated(df: DataFrame, key: str, count: str) -> DataFrame:
    """Keys with several rows, most first."""
    return df.groupBy(key).agg(F.count("*").alias(count)).filter(F.col(count) > 1).orderBy(F.desc(count), key)


def unexpected_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per column, the distinct values outside its allowed set (sorted) and whether there are none.

    The set difference is a left anti join of the distinct (column, value) pairs with the allowed pairs.
    """
    spark = df.sparkSession
    pairs = spark.createDataFrame([(c, v) for c, values in allowed.items() for v in values],
                                  "column_name string, value string")
    columns = spark.createDataFrame([(c,) for c in allowed], "column_name string")
    found = long_form(df, list(allowed)).filter(F.col("value").isNotNull()).distinct().join(
        F.broadcast(pairs), ["column_name", "value"], "left_anti")  # declared values only
    per_column = found.groupBy("column_name").agg(F.count("*").alias("unexpected_count"))
    return columns.join(per_column, "column_name", "left").select(
        "column_name", F.coalesce("unexpected_count", F.lit(0)).alias("unexpected_count"),
        F.col("unexpected_count").isNull().alias("is_valid"))


def unexpected_value_rows(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """The unexpected values themselves, one row each with their count."""
    spark = df.sparkSession
    pairs = spark.createDataFrame([(c, v) for c, values in allowed.items() for v in values],
                                  "column_name string, value string")
    counts = long_form(df, list(allowed)).filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count("*").alias("rows"))
    return counts.join(F.broadcast(pairs), ["column_name", "value"], "left_anti")  # declared values only


def anomaly_counts(df: DataFrame, not_positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """Rows with an impossible value per column: missing or ≤ 0, and below 0."""
    tests = {f"{c}_not_positive": f"{ident(c)} IS NULL OR {ident(c)} <= 0" for c in not_positive}
    tests |= {f"{c}_negative": f"{ident(c)} < 0" for c in negative}
    return long_counts(df, tests, "invalid_count").select("column_name", "invalid_count")


def anomalies(df: DataFrame, not_positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """The rows themselves."""
    tests = [F.col(c).isNull() | (F.col(c) <= 0) for c in not_positive] + [F.col(c) < 0 for c in negative]
    return df.filter(reduce(or_, tests))


def describe(df: DataFrame, columns: Sequence[str] | None = None, kind: str = "double") -> DataFrame:
    """Count, NULLs, mean, sample standard deviation, minimum, quartiles (nearest rank), maximum per column.

    With a decimal ``kind`` the sums are exact, so the result does not depend on how the rows are split over tasks;
    choose one that holds every digit of the columns in at most 18 digits. One scan sums all columns; the quartiles come
    from radix selection, whose scans run here. A table without rows has no description.
    """
    columns = list(columns or numeric_columns(df))
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*(F.col(ident(c)).cast(kind).alias(v) for c, v in zip(columns, names)))
    quartiles = select_quantiles(values, names, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, "nearest")

    def sums(name: str) -> Column:
        v = F.col(name)
        square = v * v if kind == "double" else (v * v).cast("decimal(38,8)")
        return F.struct(
            F.count(v).alias("count"), F.count_if(v.isNull()).alias("null_count"), F.sum(v).cast("double").alias("s"),
            F.sum(square).cast("double").alias("ss"), F.min(v).cast("double").alias("min"),
            F.max(v).cast("double").alias("max")).alias(name)

    one_row = values.agg(*map(sums, names))
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(v).alias("a"), *(
        F.lit(x).cast("double").alias(q) for q, x in quartiles[v].items())) for c, v in zip(columns, names)))
    rows = one_row.select(F.inline(cells)).select("column_name", "a.*", "q25", "q50", "q75").filter(
        F.col("count") + F.col("null_count") > 0)
    n = F.col("count").cast("double")
    spread = F.when(F.col("count") > 1, F.sqrt(
        F.greatest(F.lit(0.0), F.col("ss") - F.col("s") * F.col("s") / n) / (n - 1)))
    return rows.select(
        "column_name", "count", "null_count", ratio(F.col("s"), n).alias("mean"), spread.alias("std"), "min",
        "q25", "q50", "q75", "max")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes the maximum. Empty bins are shown."""
    x = F.col(column).cast("double")
    half = F.when(F.min(x) == F.max(x), 0.5).otherwise(0.0)  # a single value gets a range of width one around it
    bounds = df.agg(F.struct((F.min(x) - half).alias("low"), (F.max(x) + half).alias("high")).alias("b")).scalar()
    width = (F.col("b.high") - F.col("b.low")) / bins
    placed = df.filter(x.isNotNull()).select(x.alias("x")).withColumn("b", bounds).select(
        F.least(F.floor((F.col("x") - F.col("b.low")) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("count"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("b", bounds)
    return edges.join(counts, "bin", "left").select(
        "bin", (F.col("b.low") + F.col("bin") * width).alias("lower"),
        (F.col("b.low") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"))


def rate_by(df: DataFrame, bucket: Column, name: str, flag: str = "readmitted_30_days",
            at_least: int | None = None) -> DataFrame:
    """Mean of a flag and row count per bucket, optionally only for buckets of some size."""
    out = df.groupBy(bucket.alias(name)).agg(F.avg(flag).alias("rate"), F.count("*").alias("count"))
    return out if at_least is None else out.filter(F.col("count") >= at_least)


def rows_per_entity(df: DataFrame, key: str, cap: int = 5) -> DataFrame:
    """How many entities have 1, 2, … rows, capped."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    bucket = F.when(F.col("n") >= cap, f"{cap}+").otherwise(F.col("n").cast("string"))
    return per.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("entities"))


def several_rows_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per entity and share of entities with several rows."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("entities"), F.count_if(F.col("n") > 1).alias("entities_with_several"),
        ratio(F.sum("n"), F.count("*")).alias("rows_per_entity"),
        ratio(F.count_if(F.col("n") > 1), F.count("*")).alias("several_share"))


def shares(df: DataFrame, column: str) -> DataFrame:
    total = df.agg(F.count("*").alias("n")).scalar()
    return df.groupBy(column).agg(F.count("*").alias("count")).withColumn(
        "share", half_up(F.col("count"), total, 4))
