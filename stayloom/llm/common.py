"""What the corpus operators share: reading tables, Arrow text buffers, batch sizes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch may hold. Spark's default of 10,000 is meant for numbers; whole texts need less.
BATCH_ROWS = 512
#: Bytes after which a batch is closed, so that long texts come in smaller numbers.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for whole texts.

    Spark reads these settings when the returned frame is executed, so they have to stay on the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow text column and its n + 1 offsets into them; the texts are not copied, null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32_of_id(column: str | Column) -> Column:
    """crc32 of an integer id written as text; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
