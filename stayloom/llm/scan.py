"""Prefix sums over a table in one pass: rows are range-partitioned and sorted, every task numbers its own rows while it
writes them, and what it needs from the tasks before comes from a table of two rows per task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged

_PART, _ROW, _FIRST = "_scan_part", "_scan_row", "_scan_first"


def prefix_scan(df: DataFrame, by: Sequence[str], sums: dict[str, str], xors: dict[str, str] | None = None,
                group: str | None = None, label: str = "scanned") -> DataFrame:
    """Add running sums (and exclusive ors) of long columns in the order of ``by``, within ``group`` (a long column
    without nulls) if given. ``sums`` and ``xors`` map a new column to the one it is taken over.

    One exchange and one written table, whatever the size of a group: rows of a group may lie in many partitions.
    """
    made = {**{n: (c, np.add) for n, c in sums.items()}, **{n: (c, np.bitwise_xor) for n, c in (xors or {}).items()}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, key, held = TaskContext.get().partitionId(), 0, None, dict.fromkeys(made, 0)
        first = True
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            keys = np.asarray(batch.column(group)) if group else np.zeros(m, np.int64)
            new = np.ones(m, bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = key is None or keys[0] != key
            begin = np.maximum.accumulate(np.where(new, np.arange(m), -1))
            out = list(batch.columns)
            for name, (column, add) in made.items():
                total = add.accumulate(np.asarray(batch.column(column)).astype(np.int64))
                before = np.append(0, total)[np.maximum(begin, 0)]
                total = total ^ before if add is np.bitwise_xor else total - before
                carried = begin < 0
                total[carried] = add(total[carried], held[name])
                held[name] = total[-1]
                out.append(pa.array(total))
            opening = np.zeros(m, bool)
            opening[0], first = first, False
            out += [pa.array(np.full(m, part, np.int32)), pa.array(np.arange(at, at + m)), pa.array(opening)]
            at, key = at + m, keys[-1]
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, *made, _PART, _ROW, _FIRST])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields),
                       *(f"`{n}` long" for n in made), f"{_PART} int", f"{_ROW} long", f"{_FIRST} boolean"])
    ranged = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, kinds), label)

    key = F.col(group) if group else F.lit(0).cast("long")
    ends = ranged.groupBy(_PART).agg(F.max_by(F.struct(key.alias("g"), *made), _ROW).alias("e"))
    begins = ranged.filter(_FIRST)
    marks = ends.select(F.col("e.g").alias("_g"), (2 * F.col(_PART) + 1).alias("_at"), *(f"e.{n}" for n in made)).union(
        begins.select(key, 2 * F.col(_PART), *(F.lit(0).cast("long") for _ in made)))
    window = W.partitionBy("_g").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)

    def over(name: str) -> Column:
        return (F.bit_xor if made[name][1] is np.bitwise_xor else F.sum)(name).over(window)

    offsets = marks.select("_g", "_at", *(over(n).alias(f"_{n}") for n in made)).filter("_at % 2 = 0").select(
        "_g", (F.col("_at") / 2).cast("int").alias("_p"), *(f"_{n}" for n in made))
    joined = ranged.join(F.broadcast(offsets), (F.col(_PART) == F.col("_p")) & (key == F.col("_g")), "left")

    def whole(name: str) -> Column:
        before = F.coalesce(F.col(f"_{name}"), F.lit(0).cast("long"))
        return F.col(name).bitwiseXOR(before) if made[name][1] is np.bitwise_xor else F.col(name) + before

    return joined.select(*df.columns, *(whole(n).alias(n) for n in made))
