"""From raw documents to packed training sequences: language ID, exact dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with all their columns; the last returns the
pieces of packed sequences. :func:`run` writes every stage as Parquet to the shared folder and reads it back, so a lost
executor costs tasks of one stage only.

Defined results: null and empty texts go with the first stage; nulls in other columns are kept. Rows that repeat an id go
or stay together. Other columns of the documents, whatever their names, are handed on. An empty table passes every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.llm import decontaminate, exact, language, near, packing
from stayloom.llm.common import crc32_of_id, table
from stayloom.session import staged


def _without(docs: DataFrame, judged: DataFrame, keep: Column) -> DataFrame:
    """Leave out the documents that are not kept. Their ids are written first, so Spark knows how many there are and
    broadcasts them only where they are few. A null id is an id like any other; rows that repeat an id stay together
    if one of them is kept."""
    name = "_dropped"
    while name.lower() in (c.lower() for c in docs.columns):  # documents may have a column of that name
        name = "_" + name
    dropped = staged(judged.groupBy("doc_id").agg(F.max(keep).alias("keep")).filter("not keep").select(
        F.col("doc_id").alias(name)), "dropped-ids")
    return docs.join(dropped, docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that no language can be given to go: null, or without a letter. Labels are learned from two thirds; where
    none can be learned, texts with a letter stay all the same."""
    net = language.fit(docs.filter(crc32_of_id("doc_id") % 3 != 1))
    if net is None:
        return _without(docs, docs, language.has_letter(F.col("text")))
    return _without(docs, language.identify(docs, net), F.col("lang_pred") != language.UNKNOWN)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, exact.exact_duplicates(docs), F.col("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return _without(docs, near.near_duplicates(docs), F.col("kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, judged, ~F.col("contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL can express the network, the tokenizer or the schedule; tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
