"""Joins with tables that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: Repeated keys up to which they are broadcast, so that the rows they are looked up in are not shuffled.
BROADCAST_KEYS = 200_000


def merged(df: DataFrame) -> DataFrame:
    """Have a join take this side by a sort and merge.

    Spark chooses what it broadcasts by the compressed size of the files and the share of the columns that are read. Keys
    and flags of millions of rows then look like a few megabytes, and the driver would build them as a hash table.
    """
    return df.hint("merge")


def looked_up(keys: DataFrame, at_most: int) -> DataFrame:
    """A table of repeated keys as the side of a join that rows are looked up in. It is written and counted first: Spark learns
    its size only when the rows are shuffled already. Up to ``at_most`` keys are broadcast, more are sorted and merged."""
    stored = staged(keys, "repeated")
    return F.broadcast(stored) if stored.count() <= at_most else merged(stored)
