"""Row-rule evaluation, valid/quarantine split, summaries and checks.

All row-local rules are evaluated in one scan. A cheap exact-match test first sets aside the rows that obviously
break nothing; only the rest are expanded against the full rule list, so the expensive part grows with the number
of suspicious rows and not with rows times rules. The test may suspect too much, never too little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import percent
from ..functions.text import (ident, inside_sql, integer_sql, is_missing, listed, literal, missing_sql, not_allowed_sql,
                              out_of_bounds_sql, strip_sql)
from ..schema import MISSING_TOKENS, RuleSet
from .joins import BROADCAST_KEYS, looked_up, merged
from .order import repeated_keys
from .reshape import melt

VIOLATION_COLUMNS = ("row_id", "rule_name", "column_name", "invalid_value", "rejection_reason")


def missing_columns(df: DataFrame, expected) -> list[str]:
    """Sorted names of the declared columns a table lacks; extra columns are fine."""
    return sorted(set(expected) - set(df.columns))


def require_columns(df: DataFrame, expected) -> DataFrame:
    absent = missing_columns(df, expected)
    if absent:
        raise ValueError("Missing columns: " + ", ".join(absent))
    return df


def column_presence(df: DataFrame, expected) -> DataFrame:
    """One row per declared column: is it there?"""
    return df.sparkSession.createDataFrame(
        [(c, c in df.columns) for c in expected], "column_name string, present boolean")


# --- row rules ---------------------------------------------------------------------------------------------------

RULE_SCHEMA = ("column_name string, rule_name string, low bigint, high bigint, allowed array<string>, "
               "rejection_reason string")


def rule_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The row-local rules as a table, one row per (rule, column)."""
    return spark.createDataFrame([
        *((c, "required_value", None, None, None, rules.required_reason) for c in rules.required),
        *((c, "invalid_numeric_value", low, high, None, why) for c, (low, high, why) in rules.bounds.items()),
        *((c, "invalid_category", None, None, list(allowed), rules.category_reason)
          for c, allowed in rules.allowed.items()),
    ], RULE_SCHEMA)


def suspicious(rules: RuleSet) -> Column:
    """True for every row that breaks a row-local rule (and for some that break none). Never NULL."""
    return F.expr(_suspicious_sql(rules))


def _suspicious_sql(rules: RuleSet) -> str:
    tests = [f"NOT {inside_sql(ident(c), low, high)}" for c, (low, high, _) in rules.bounds.items()]
    for c, allowed in rules.allowed.items():
        optional = c in rules.optional
        values = (*allowed, *MISSING_TOKENS) if optional else allowed
        tests.append(f"NOT coalesce({ident(c)} IN ({listed(values)}), {str(optional).lower()})")
    return " OR ".join(tests) or "false"


def breaks_row_rule(rules: RuleSet) -> Column:
    """Exact: does the row break any row-local rule? Cheap test first, full rules only where it fires.

    Columns under the same rule are tested together as one array, which keeps the generated code small.
    """
    groups: dict[str, list[str]] = {}
    for c in rules.required:
        groups.setdefault(missing_sql("x"), []).append(c)
    for c, (low, high, _) in rules.bounds.items():
        groups.setdefault(out_of_bounds_sql("x", low, high, rules.allow_padding), []).append(c)
    for c, allowed in rules.allowed.items():
        groups.setdefault(not_allowed_sql("x", allowed), []).append(c)
    exact = " OR ".join(f"exists(array({', '.join(map(ident, columns))}), x -> {broken})"
                        for broken, columns in groups.items())
    return F.expr(f"({_suspicious_sql(rules)}) AND ({exact or 'false'})")


def row_violations(rows: DataFrame, rules: RuleSet, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per broken row-local rule; ``carry`` keeps columns of the offending row, so no join is needed.

    Suspicious rows become (row, column, value) triples that meet the rule table, whose size is the number of
    declared rules.
    """
    checked = list(dict.fromkeys((*rules.required, *rules.bounds, *rules.allowed)))
    triples = melt(rows.filter(suspicious(rules)), ["row_id", *carry], checked, "column_name", "value")
    broken = F.expr(f"""CASE rule_name
        WHEN 'required_value' THEN {missing_sql('value')}
        WHEN 'invalid_numeric_value' THEN NOT {missing_sql('value')} AND NOT coalesce(
            {integer_sql('value', rules.allow_padding)} >= low
            AND (high IS NULL OR {integer_sql('value', rules.allow_padding)} <= high), false)
        ELSE NOT {missing_sql('value')} AND NOT array_contains(allowed, {strip_sql('value')}) END""")
    return triples.join(F.broadcast(rule_table(rows.sparkSession, rules)), "column_name").filter(broken).select(
        "row_id", "rule_name", "column_name", F.coalesce("value", F.lit("<NULL>")).alias("invalid_value"),
        "rejection_reason", *carry)


def _violation(rule: str, column: str, value: Column, reason: str) -> Column:
    return F.struct(F.lit(rule).alias("rule_name"), F.lit(column).alias("column_name"),
                    value.cast("string").alias("invalid_value"), F.lit(reason).alias("rejection_reason"))


def key_duplicates(rows: DataFrame, rules: RuleSet, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every copy of a repeated, non-missing key (compared as raw text) is a violation."""
    repeated = looked_up(repeated_keys(rows, rules.key, is_missing(ident(rules.key))).select(rules.key), BROADCAST_KEYS)
    return rows.join(repeated, rules.key, "left_semi").select(
        "row_id",
        _violation(f"duplicate_{rules.key}", rules.key, F.col(rules.key), rules.key_reason).alias("v"), *carry,
    ).select("row_id", "v.*", *carry)


def row_duplicates(rows: DataFrame, rules: RuleSet, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every copy of a row that is repeated in all declared columns (NULLs equal).

    Equal rows have equal keys, so only rows under a repeated key are compared in full; without a key, a hash of
    the row narrows them down. The full comparison is a count per distinct row, never a group in one task. The repeated
    ones are written and counted first: rows are shuffled only where these are too many to broadcast.
    """
    columns = list(rules.columns)
    if rules.key:
        probe = rows.withColumn("_probe", F.col(rules.key))
    else:
        probe = rows.withColumn("_probe", F.xxhash64(*columns))
    repeated = looked_up(repeated_keys(probe, "_probe").select(F.col("_probe").alias("_again")), BROADCAST_KEYS)
    candidates = probe.join(repeated, F.col("_probe").eqNullSafe(F.col("_again")), "left_semi")
    copies = (
        candidates.groupBy(*columns).agg(F.count("*").alias("_copies")).filter("_copies > 1")
        .select(*(F.col(c).alias(f"_same_{c}") for c in columns))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in columns]
    return candidates.join(copies, same, "left_semi").select(
        "row_id", _violation("exact_duplicate_row", "*", F.lit("<duplicate row>"), rules.row_reason).alias("v"),
        *carry,
    ).select("row_id", "v.*", *carry)


def violations(rows: DataFrame, rules: RuleSet, carry: tuple[str, ...] = (), as_of: str | None = None) -> DataFrame:
    """The violation table: one row per broken rule and row; one row of data may break many rules."""
    found = row_violations(rows, rules, carry)
    if rules.key:
        found = found.unionByName(key_duplicates(rows, rules, carry))
    found = found.unionByName(row_duplicates(rows, rules, carry))
    rejected_at = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return found.select(*VIOLATION_COLUMNS, rejected_at.alias("rejected_at"), *carry)


# --- split -------------------------------------------------------------------------------------------------------

def valid_rows(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows that break nothing: one filter over the scan plus an anti join with the repeated keys, which are found here.

    A repeated row shares its key with its copies, and a missing key already breaks the required rule, so with a
    required key the full-row comparison cannot reject anything more and is left out.
    """
    kept = rows.filter(~breaks_row_rule(rules))
    if rules.key:
        repeated = repeated_keys(rows, rules.key, is_missing(ident(rules.key))).select(rules.key)
        kept = kept.join(looked_up(repeated, BROADCAST_KEYS), rules.key, "left_anti").select(*rows.columns)
    if rules.key is None or rules.key not in rules.required:
        kept = kept.join(row_duplicates(rows, rules).select("row_id"), "row_id", "left_anti").select(*rows.columns)
    return kept


def without_violations(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows minus the rows of a stored violation table."""
    return rows.join(found.select("row_id").distinct(), "row_id", "left_anti").select(*rows.columns)


def quarantine(rows: DataFrame, rules: RuleSet, as_of: str | None = None) -> DataFrame:
    """Violation-grain quarantine: the violation and the whole offending row."""
    return violations(rows, rules, carry=tuple(rules.columns), as_of=as_of)


def quarantine_from(found: DataFrame, rows: DataFrame, rules: RuleSet) -> DataFrame:
    """The same from a stored violation table."""
    return found.join(rows.select("row_id", *rules.columns), "row_id", "left").select(
        *found.columns, *rules.columns)


# --- summaries ---------------------------------------------------------------------------------------------------

def violation_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("rule_name", "column_name", "rejection_reason").agg(
        F.count("*").alias("violation_count")
    ).orderBy(F.desc("violation_count"), "rule_name", "column_name")


def long_counts(df: DataFrame, counters: dict[str, str], count: str) -> DataFrame:
    """One pass over the table, one output row per counter: ``(column_name, <count>, total_rows)``.

    The counters are SQL conditions by name.
    """
    one_row = df.agg(F.count("*").alias("total_rows"), *(
        F.expr(f"count_if({condition}) AS c{i}") for i, condition in enumerate(counters.values())))
    cells = ", ".join(f"{literal(name)}, c{i}" for i, name in enumerate(counters))
    return one_row.select(F.expr(f"stack({len(counters)}, {cells}) AS (column_name, {count})"), "total_rows")


def missing_summary(df: DataFrame, columns) -> DataFrame:
    """Missing values per column, with their share in percent."""
    counts = long_counts(df, {c: missing_sql(ident(c)) for c in columns}, "missing_count")
    return counts.select(
        "column_name", "missing_count",
        percent(F.col("missing_count"), F.col("total_rows"), 4).alias("missing_rate_percent"),
    ).orderBy(F.desc("missing_count"), "column_name")


def run_totals(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Run totals: rows, valid, rejected (distinct), violations, duplicate rows, valid rate."""
    per_row = found.groupBy("row_id").agg(
        F.count("*").alias("n"), F.max(F.col("rule_name") == "exact_duplicate_row").alias("copy"))
    rejected = per_row.agg(
        F.count("*").alias("rejected_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_violations"),
        F.count_if("copy").alias("duplicate_rows"))
    total = rows.agg(F.count("*").alias("n")).scalar()
    out = rejected.withColumn("total_rows", total).withColumn(
        "valid_rows", F.col("total_rows") - F.col("rejected_rows"))
    return out.select("total_rows", "valid_rows", "rejected_rows", "total_violations", "duplicate_rows",
                      percent(F.col("valid_rows"), F.col("total_rows"), 4).alias("valid_rate_percent"))


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of each column."""
    return df.sparkSession.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)],
        "position int, column_name string, data_type string")


# --- checks: one row per check, failed_rows = 0 means passed -------------------------------------------------------

def key_checks(df: DataFrame, key: str) -> list[Column]:
    """Aggregates over a table already grouped by key with column ``copies``."""
    return [
        F.sum(F.when(F.col(key).isNull(), F.col("copies")).otherwise(0)).alias("key_not_null"),
        F.sum(F.col("copies") - 1).alias("key_unique"),
    ]


def check_rows(one_row: DataFrame) -> DataFrame:
    """Turn a one-row table of failure counts into check rows."""
    cells = ", ".join(f"{literal(c)}, coalesce(CAST({ident(c)} AS BIGINT), 0L)" for c in one_row.columns)
    return one_row.select(F.expr(f"stack({len(one_row.columns)}, {cells}) AS (check_name, failed_rows)"))


def unique_key(df: DataFrame, key: str) -> DataFrame:
    """NOT NULL and UNIQUE of a key, two-level count so that no distinct set is held in one place."""
    return check_rows(df.groupBy(key).agg(F.count("*").alias("copies")).agg(*key_checks(df, key)))


def not_empty(df: DataFrame) -> DataFrame:
    return check_rows(df.agg((F.count("*") == 0).cast("int").alias("not_empty")))


def values_in_domain(df: DataFrame, domains: dict[str, tuple]) -> DataFrame:
    """Rows whose value is outside the domain; NULL passes."""
    return check_rows(df.agg(*(F.count_if(~F.col(c).isin(*d)).alias(f"domain_{c}") for c, d in domains.items())))


def foreign_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent. Rows are counted by key first, so only distinct keys are joined."""
    parents = merged(parent.select(F.col(parent_key).alias("_parent")))
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    orphans = keys.join(parents, F.col(column) == F.col("_parent"), "left_anti")
    return check_rows(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name)))


def curated_checks(df: DataFrame, key: str, integers) -> DataFrame:
    """Checks after the clean step: rows, key, integer types, no missing token left in any text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    one_pass = df.agg(
        (F.count("*") == 0).cast("int").alias("not_empty"),
        *(F.lit(int(df.schema[c].dataType != T.LongType())).alias(f"bigint_{c}") for c in integers),
        *(F.expr(f"count_if({strip_sql(c)} = '?') AS no_question_mark_{c}") for c in texts),
    )
    return check_rows(one_pass).unionByName(unique_key(df, key))


def feature_checks(df: DataFrame, key: str, flags) -> DataFrame:
    return not_empty(df).unionByName(unique_key(df, key)).unionByName(
        values_in_domain(df, {c: (0, 1) for c in flags}))


def raise_on_failure(checks: DataFrame) -> None:
    """Stop a chain on the first failed check (at most one row per check reaches the driver)."""
    failed = checks.filter("failed_rows > 0").orderBy("check_name").first()
    if failed:
        raise ValueError(f"{failed['check_name']}: {failed['failed_rows']} rows")


def reconcile(written: DataFrame, read: DataFrame, key: str) -> DataFrame:
    """Input rows, stored rows and distinct stored keys side by side."""
    keys = read.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("stored_rows"), F.count(key).alias("distinct_keys"))
    return keys.select(
        written.agg(F.count("*").alias("n")).scalar().alias("input_rows"), "stored_rows", "distinct_keys"
    ).withColumn("reconciled", (F.col("input_rows") == F.col("stored_rows"))
                 & (F.col("stored_rows") == F.col("distinct_keys")))
