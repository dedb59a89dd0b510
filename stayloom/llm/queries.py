"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from . import (chat, decontaminate, exact, golay, language, near, packing, pii, secrets, toxicity, trie, warc,
               whitening)
from .common import crc32_of_id, table


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(  # conversation -1: a user row, then an assistant row
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, folder, "conversations").select(*extra.columns).unionByName(extra)
    return chat.conversation_digests(chat.chat_windows(rows))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = staged(secrets.candidates(documents), "candidates")
    return secrets.secrets(found, secrets.fit(documents, secrets.weak_labels(found)))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = crc32_of_id("doc_id") % 5 == 0
    model = toxicity.fit(documents.filter(~held_out), labels.filter(~held_out))
    return toxicity.score_documents(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.archive_folder(spark)
    index = warc.write_archives(warc.with_record_types(table(spark, folder, "pages")), archive)
    read = warc.read_records(index, archive)
    held = F.col("payload").isNotNull()
    return read.select(
        F.col("record_id").alias("page_id"),
        F.when(held, F.octet_length("payload").cast("long")).otherwise(F.col("header_bytes")).alias("payload_bytes"),
        F.when(held, F.sha1("payload")).otherwise(F.col("header_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymised(table(spark, folder, "documents"), pii.DEMO_KEY)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = crc32_of_id("doc_id") % 3 == 1
    net = language.fit(documents.filter(~held_out))
    return language.identify(documents, net).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "shares")


def op11_golay(spark: SparkSession, folder: str) -> DataFrame:
    return golay.near_fingerprints(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_secrets": op3_secrets,
    "op4_toxicity": op4_toxicity,
    "op5_minhash": op5_minhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_language_id": op10_language_id,
    "op11_golay": op11_golay,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
