"""Global order without a single-partition window: dense keys, running totals, exact quantiles, first-per-key.

A window with no partition column sends the whole table to one task. Here the rows are range-partitioned and
sorted instead, each partition numbers its own rows, and the (partition-count sized) table of partition totals
gives every partition its offset. The ranged table is written once, because sampled range bounds may differ
between two evaluations of the same plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged
from .joins import BROADCAST_KEYS, looked_up

_PART, _ROW = "_range_part", "_range_row"


def _ranged(df: DataFrame, by: Sequence[str], label: str,
            unfold: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    part = F.spark_partition_id()
    return staged(
        unfold(df.repartitionByRange(*by).sortWithinPartitions(*by))
        .withColumn(_PART, part)
        .withColumn(_ROW, F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)),
        label,
    )


def _before(totals: DataFrame, group: Sequence[str], value: str) -> Column:
    """Sum of ``value`` over the earlier partitions. ``totals`` has one row per partition (and group in it)."""
    window = W.partitionBy(*group).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def dense_key(df: DataFrame, by: Sequence[str], name: str,
              unfold: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Add ``name`` = 1..n in the order of ``by``; same as ``row_number() over (order by …)`` for a unique order.

    ``unfold`` may turn each row into several, row by row (projections, filters and generators only): these are numbered,
    in the order it gives them, and only the rows it was given are sorted.
    """
    ranged = _ranged(df, by, name, unfold)
    counts = ranged.groupBy(_PART).agg(F.count("*").alias("_n"))
    offsets = counts.select(_PART, _before(counts, [], "_n").alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), _PART)  # one row per range partition
        .select((F.col("_offset") + F.col(_ROW) + 1).alias(name), *(c for c in ranged.columns if c not in (_PART, _ROW)))
    )


def running_total(df: DataFrame, by: Sequence[str], sums: dict[str, str], group: Sequence[str] = ()) -> DataFrame:
    """Add running totals (current row included) in the order of ``by`` within ``group``.

    ``sums`` maps a new column to the integer column it totals.
    """
    group = list(group)
    ranged = _ranged(df, [*group, *by], "running")
    totals = ranged.groupBy(*group, _PART).agg(*(F.sum(c).alias(f"_part_{n}") for n, c in sums.items()))
    offsets = totals.select(
        *(F.col(g).alias(f"_group_{g}") for g in group), F.col(_PART).alias("_p"),
        *(_before(totals, group, f"_part_{n}").alias(f"_before_{n}") for n in sums))
    inside = W.partitionBy(*group, _PART).orderBy(_ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.select("*", *(F.sum(c).over(inside).alias(f"_local_{n}") for n, c in sums.items()))
    match = [F.col(_PART) == F.col("_p"), *(F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in group)]
    joined = local.join(offsets, match)
    return joined.select(
        *df.columns, *((F.col(f"_before_{n}") + F.col(f"_local_{n}")).alias(n) for n in sums))


def carry_forward(df: DataFrame, by: Sequence[str], value: str, group: Sequence[str] = ()) -> DataFrame:
    """Replace NULLs of ``value`` by the last earlier non-NULL value in the order of ``by`` within ``group``.

    A range partition fills from its own rows; what it needs from before comes from the last values of the earlier
    partitions, one row per partition and group, so even a single huge group is spread over many tasks.
    """
    group = list(group)
    ranged = _ranged(df, [*group, *by], "carry")
    last = ranged.filter(F.col(value).isNotNull()).groupBy(*group, _PART).agg(F.max_by(value, _ROW).alias("_last"))
    parts = ranged.groupBy(*group, _PART).agg(F.count("*").alias("_n")).join(
        last.select(*(F.col(g).alias(f"_last_{g}") for g in group), F.col(_PART).alias("_last_part"), "_last"),
        [F.col(_PART) == F.col("_last_part"), *(F.col(g).eqNullSafe(F.col(f"_last_{g}")) for g in group)], "left")
    earlier = W.partitionBy(*group).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(
        *(F.col(g).alias(f"_group_{g}") for g in group), F.col(_PART).alias("_p"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried")).filter(F.col("_carried").isNotNull())
    inside = W.partitionBy(*group, _PART).orderBy(_ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    match = [F.col(_PART) == F.col("_p"), *(F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in group)]
    return local.join(carried, match, "left").withColumn(value, F.coalesce(value, "_carried")).select(*df.columns)


def value_ranks(values: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values with their count and the rank of their last copy: ``(group…, value, n, last_rank)``.

    Copies of a hot value collapse in the map-side count before anything is sorted.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    return running_total(counts, [value], {"last_rank": "n"}, group)


def quantiles(values: DataFrame, value: str, wanted: dict[str, float], group: Sequence[str] = (),
              method: str = "linear") -> DataFrame:
    """Exact quantiles per group: ``linear`` interpolates at (n-1)·q, ``nearest`` takes the rounded position."""
    group = list(group)
    ranks = value_ranks(values.select(*group, value), group, value).withColumn(
        "_first", F.col("last_rank") - F.col("n"))  # zero-based position of the first copy
    sizes = values.groupBy(*group).agg(F.count(value).alias("_size"))
    if group:
        renamed = sizes.select(*(F.col(g).alias(f"_g_{g}") for g in group), "_size")
        ranks = ranks.join(renamed, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    else:
        ranks = ranks.withColumn("_size", sizes.select("_size").scalar())
    at = {}
    for name, q in wanted.items():
        position = (F.col("_size") - 1) * F.lit(float(q))
        if method == "nearest":
            position = F.floor(position + 0.5).cast("double")
        low, high = F.floor(position), F.ceil(position)

        def holds(index):
            return (F.col("_first") <= index) & (index < F.col("last_rank"))

        at[name] = (F.max(F.when(holds(low), F.col(value))), F.max(F.when(holds(high), F.col(value))),
                    F.max(position - low))
    picked = ranks.groupBy(*group).agg(*(
        c.alias(f"{n}_{k}") for n, parts in at.items() for k, c in zip(("lo", "hi", "w"), parts)))
    return picked.select(*group, *(
        (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")).cast("double").alias(n)
        for n in wanted))


def first_per_key(df: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """Values of the row with the lowest ``order`` per key; partial aggregation, so a hot key stays small."""
    return df.groupBy(key).agg(F.min_by(F.struct(*values), order).alias("_first")).select(key, "_first.*")


def keep_first(rows: DataFrame, key: str, order: str = "row_id") -> DataFrame:
    """Keep the first row of every key (NULL is a key too), in input order.

    Only the narrow ``(key, order)`` pairs are shuffled; keys that occur once never leave their scan unless the
    table of repeated keys, which is found here, is too large to broadcast.
    """
    repeated = (
        rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), F.min(order).alias("_keep"))
        .filter("_n > 1").select("_key", "_keep", F.lit(True).alias("_repeated"))
    )
    return (
        rows.join(looked_up(repeated, BROADCAST_KEYS), F.col(key).eqNullSafe(F.col("_key")), "left")
        .filter(F.col("_repeated").isNull() | (F.col(order) == F.col("_keep")))
        .select(*rows.columns)
    )


def repeated_keys(rows: DataFrame, key: str, missing: Column | None = None) -> DataFrame:
    """Keys that occur more than once, optionally leaving out missing ones: ``(key, copies)``."""
    kept = rows.select(key) if missing is None else rows.filter(~missing).select(key)
    return kept.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
