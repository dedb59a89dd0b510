"""Exact dedup over content-defined chunk recipes.

A normalised text is cut where the hash of the last eight bytes says so. Equal passages are cut alike wherever they
stand, so the corpus has far fewer different chunks than chunks. Every different chunk is moved once, to verify that
no two contents share an identifier; from then on a document is its ordered list of identifiers, some 8 bytes for each
2 kB of text, and only these lists are compared and shuffled.

Identifiers are 64-bit hashes. Where the verification finds two contents under one hash, each of them gets an ordinal,
and the lists that contain such a hash carry the ordinals too, so that equal lists always mean equal texts.

Defined results: a null text is the empty text, whose list is empty; all empty texts are copies of each other. Rows that
repeat a ``doc_id`` with the same text are kept or dropped together. A null ``doc_id`` stays only if all ids of its
group are null. Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged
from .common import text_batches, utf8

#: Chunk sizes in bytes. A cut is offered once in MEAN bytes on average.
SHORTEST, MEAN, LONGEST = 512, 2048, 16384

_WINDOW, _BLOCK = 8, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _offered_cuts(data: np.ndarray) -> np.ndarray:
    """Positions after which the last eight bytes ask for a cut."""
    shift = np.uint64(64 - (MEAN.bit_length() - 1))
    found = []
    for start in range(0, len(data) - _WINDOW + 1, _BLOCK):
        n = min(_BLOCK, len(data) - _WINDOW + 1 - start)
        windows = np.ndarray((n,), "<u8", data[start:start + n + _WINDOW - 1], strides=(1,))
        found.append(np.flatnonzero((windows * _MIX) >> shift == 0) + (start + _WINDOW))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_bounds(data: np.ndarray, start: int, end: int, offered: np.ndarray) -> list[int]:
    """Ends of the chunks of ``data[start:end]``; a cut depends on bytes of the text alone."""
    low = np.searchsorted(offered, start + _WINDOW)
    mine = offered[low:np.searchsorted(offered, end)].tolist()
    ends, at, k = [], start, 0
    while at < end:
        limit = min(at + LONGEST, end)
        while k < len(mine) and mine[k] < at + SHORTEST:
            k += 1
        at = mine[k] if k < len(mine) and mine[k] < limit else limit
        ends.append(at)
    return ends


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        base, top = int(offsets[0]), int(offsets[-1])
        data = np.ascontiguousarray(data[base:top])
        offsets = offsets - base
        offered = _offered_cuts(data)
        ends, counts = [0], [0]
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            ends += chunk_bounds(data, start, end, offered)
            counts.append(len(ends) - 1)
        values = pa.Array.from_buffers(
            pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(data)])
        chunks = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("sha"), chunks], names=["doc_id", "sha", "chunks"])


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``sha`` of the normalised text and its ``chunks`` in order."""
    text_batches(docs.sparkSession)
    norm = docs.select(F.col(id_column).cast("long").alias("doc_id"), normalised(F.col(text_column)).alias("text"))
    return norm.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha")).mapInArrow(
        _chunk, "doc_id long, sha string, chunks array<binary>")


def _key(chunk: Column, mask: int) -> Column:
    return F.xxhash64(chunk).bitwiseAND(F.lit(mask).cast("long"))


def verified_recipes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     mask: int = -1) -> DataFrame:
    """One row per document: ``doc_id``, ``sha``, ``recipe`` (hashes in order), ``ordinals``.

    ``ordinals`` is null unless the recipe has a hash that stands for several contents. ``mask`` keeps only some bits
    of a hash, for tests of that case.
    """
    recipes = staged(chunked(docs, id_column, text_column).select(
        "doc_id", "sha", F.transform("chunks", lambda c: _key(c, mask)).alias("recipe")), "recipes")
    pieces = chunked(docs, id_column, text_column).select("doc_id", "sha", F.posexplode("chunks").alias("pos", "chunk"))
    contents = pieces.select(_key(F.col("chunk"), mask).alias("h"), "chunk").distinct()  # partial: copies stay local
    shared = staged(contents.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "shared-hashes")
    if shared.isEmpty():
        return recipes.withColumn("ordinals", F.lit(None).cast("array<int>"))
    ranked = staged(contents.join(shared, "h", "left_semi").withColumn(
        "ord", F.row_number().over(W.partitionBy("h").orderBy("chunk"))), "ranked-contents")
    at = (pieces.withColumn("h", _key(F.col("chunk"), mask)).join(ranked, ["h", "chunk"])
          .groupBy("doc_id", "sha").agg(F.sort_array(F.collect_set(F.struct("pos", "ord"))).alias("at")))
    ordinals = at.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"),
                         F.transform("at", lambda x: x["ord"]).alias("ordinals"))
    return recipes.join(ordinals, recipes.doc_id.eqNullSafe(F.col("_id")) & (recipes.sha == F.col("_sha")),
                        "left").select("doc_id", "sha", "recipe", "ordinals")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     mask: int = -1) -> DataFrame:
    """Every document with the copy that stays: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Groups are pre-aggregated where they are read. The join that hands the result back has one row per list on one
    side, so Spark can split a list that a third of all documents share.
    """
    recipes = verified_recipes(docs, id_column, text_column, mask)
    groups = recipes.groupBy(F.col("recipe").alias("_recipe"), F.col("ordinals").alias("_ordinals")).agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    same = (recipes.recipe == groups["_recipe"]) & recipes.ordinals.eqNullSafe(groups["_ordinals"])
    return recipes.join(groups, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))
