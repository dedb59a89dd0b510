"""Change of a value from one row of a time line to the next, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .order import dense_key

_BLOCK = 100_000


def trend(df: DataFrame, at: list[str], value: str) -> DataFrame:
    """Add ``previous_<value>`` and ``<value>_change`` in the order of ``at`` (unique).

    Rows get their global position; ``lag`` then works inside blocks of positions, and the first row of a block
    finds its predecessor through a copy of the last row of the block before it.
    """
    numbered = dense_key(df, at, "_pos")
    rows = numbered.withColumn("_copy", F.lit(False)).withColumn("_block", F.floor(F.col("_pos") / _BLOCK))
    last = rows.filter(F.col("_pos") % _BLOCK == _BLOCK - 1).withColumn("_copy", F.lit(True)).withColumn(
        "_block", F.col("_block") + 1)
    inside = W.partitionBy("_block").orderBy("_pos")
    return (
        rows.unionByName(last)
        .withColumn(f"previous_{value}", F.lag(value).over(inside))
        .filter(~F.col("_copy"))
        .withColumn(f"{value}_change", F.col(value) - F.col(f"previous_{value}"))
        .drop("_pos", "_block", "_copy")
    )
