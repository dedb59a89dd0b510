"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Each text becomes words; each run of GRAM words is hashed; each window of WINDOW words keeps the smallest of its gram
hashes. Neighbouring windows mostly keep the same one, so a text posts one fingerprint for some three words. Two equal
windows keep equal hashes, hence every shared span of WINDOW words or more shares a fingerprint, whatever surrounds it.
Matching fingerprints are then extended: every window behind one is compared, word for word, with the windows of the
benchmark, and the words of those that are equal are hit.

Benchmark items of fewer than WINDOW words are one window each; for every such length that occurs (twelve at most) the
documents post the hashes of their runs of that many words as well.

Where the distinct benchmark fingerprints number at most BROADCAST_ROWS (16 bytes each) they are broadcast and the
documents are read once without a shuffle; beyond that both sides are shuffled by fingerprint.

Defined results: a null text has no words. A document without words has no hits. Rows that repeat a ``doc_id`` are
judged one by one; repeated items count once by ``item_id``, and a null ``item_id`` is listed as an empty name. Empty
tables give no hits or no rows. Other columns of either input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import ascii_lower

WINDOW, GRAM = 13, 9
_HASHES = WINDOW - GRAM + 1
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _head(array: str, n: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(n, F.lit(0)))


def _run_hash(length: int):
    """Hash of the ``length`` words from position i on."""
    return lambda h, i: F.xxhash64(F.lit(length), h, *(F.get("hashes", i + k) for k in range(1, length)))


def _single(length: int, post):
    """Post of the run of ``length`` words at position i, which is a window by itself."""
    run = _run_hash(length)
    return lambda h, i: post(run(h, i), i, i + 1, length)


def fingerprints(texts: DataFrame, short_lengths: list[int]) -> DataFrame:
    """Add ``posts``: array of (fingerprint, first and last window position + 1, words a window has).

    ``texts`` has a column ``words``. Each step is a projection of its own: what a lambda reads must be a column, or
    it would be computed again for each element. Callers explode the posts with the outer variants, because for the
    inner ones Spark would push a test of the whole expression below all these steps.
    """
    n = F.size("words")
    step = texts.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    step = step.withColumn("grams", F.transform(_head("hashes", n - GRAM + 1), _run_hash(GRAM)))
    step = step.withColumn("least", F.transform(
        _head("grams", n - WINDOW + 1),
        lambda g, i: F.least(g, *(F.get("grams", i + k) for k in range(1, _HASHES)))))
    step = step.withColumn("starts", F.array_compact(F.transform(
        "least", lambda m, i: F.when((i == 0) | (m != F.get("least", i - 1)), i))))

    def post(m, start, stop, length):
        return F.struct(m.alias("m"), start.alias("start"), stop.alias("stop"), F.lit(length).alias("length"))

    posts = [F.transform("starts", lambda s, j: post(
        F.get("least", s), s, F.coalesce(F.get("starts", j + 1), F.size("least")), WINDOW))]
    for length in short_lengths:
        posts.append(F.transform(_head("hashes", n - length + 1), _single(length, post)))
    return step.withColumn("posts", F.concat(*posts)).drop("hashes", "grams", "least", "starts")


def _gram(at: Column | str, length: Column | str) -> Column:
    at, length = (F.col(x) if isinstance(x, str) else x for x in (at, length))
    return F.array_join(F.slice("words", at + 1, length), " ")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text: str = "text",
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, item_ids`` (sorted names) and ``contaminated``: 5 % of its words hit."""
    items = benchmark.select(F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"),
                             words(F.col(item_text)).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("n", F.size("words"))
    lengths = sorted(r.n for r in items.filter(F.col("n") < WINDOW).select("n").distinct().collect())  # 12 at most
    spans = items.select("item", "words", F.least("n", F.lit(WINDOW)).alias("length"), F.explode(
        F.sequence(F.lit(0), F.greatest(F.col("n") - WINDOW, F.lit(0)))).alias("at"))
    windows = staged(spans.select(_gram("at", "length").alias("gram"), "item").distinct(), "benchmark-windows")
    prints = staged(fingerprints(items, lengths).select("n", F.explode_outer("posts").alias("p")).filter(
        F.col("p.length") == F.least("n", F.lit(WINDOW))).select(F.col("p.m").alias("m")).distinct()
        if lengths else fingerprints(items, []).select(F.explode_outer("posts.m").alias("m")).distinct(),
        "benchmark-fingerprints")

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("text_key"),
                        words(F.col(text_column)).alias("words"))
    texts = texts.withColumn("n_words", F.size("words"))
    # one more post without a fingerprint takes each document through the join
    none = F.struct(F.lit(None).cast("long").alias("m"), F.lit(-1).alias("start"), F.lit(-1).alias("stop"),
                    F.lit(0).alias("length"))
    posted = fingerprints(texts, lengths).withColumn("posts", F.concat("posts", F.array(none)))
    known = prints.select(F.col("m").alias("known"))
    if prints.count() <= broadcast_rows:
        scan = posted.select("doc_id", "text_key", "n_words", "words", F.inline_outer("posts")).join(
            F.broadcast(known), F.col("m") == F.col("known"), "left").filter("start < 0 or known is not null")
        scan = staged(scan.select("doc_id", "text_key", "n_words", "start", "length", F.when(
            F.col("start") >= 0, F.transform(F.sequence("start", F.col("stop") - 1), lambda i: _gram(i, "length"))
        ).alias("grams")), "document-windows")
    else:
        narrow = posted.select("doc_id", "text_key", "n_words", F.inline_outer("posts"))
        found = staged(narrow.join(known, F.col("m") == F.col("known"), "left")
                       .filter("start < 0 or known is not null").drop("m", "known"), "matched-posts")
        runs = found.filter("start >= 0").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
            F.collect_set(F.struct("start", "stop", "length")).alias("runs"))
        back = texts.join(runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
        back = back.dropDuplicates(["doc_id", "text_key"]).select(
            "doc_id", "text_key", "n_words", "words", F.inline("runs"))
        scan = staged(found.filter("start < 0").select(
            "doc_id", "text_key", "n_words", "start", "length", F.lit(None).cast("array<string>").alias("grams"))
            .unionByName(back.select(
                "doc_id", "text_key", "n_words", "start", "length",
                F.transform(F.sequence("start", F.col("stop") - 1), lambda i: _gram(i, "length")).alias("grams"))),
            "document-windows")

    at = scan.filter("start >= 0").select("doc_id", "text_key", "start", "length", F.posexplode("grams").alias(
        "k", "gram")).select("doc_id", "text_key", (F.col("start") + F.col("k")).alias("at"), "length", "gram")
    grams = windows.select(F.col("gram").alias("_gram")).distinct()
    hits = at.join(grams, F.col("gram") == F.col("_gram"), "left_semi").distinct()
    key = ["doc_id", "text_key"]
    spans_hit = hits.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("at", "length"))).alias("spans"))
    covered = F.aggregate(  # words in the union of the spans, which come in order
        "spans", F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["to"], s["at"] + s["length"]).alias("to"),
            (a["n"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(a["to"], s["at"]))).alias("n")),
        lambda a: a["n"])
    items_hit = hits.select(*key, "gram").distinct().join(windows, "gram").select(*key, "item").distinct().groupBy(
        *key).agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    found = spans_hit.select(*key, covered.cast("long").alias("n_hit")).join(
        items_hit.select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_k"), "item_ids"),
        F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("text_key") == F.col("_k"))).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_hit", "item_ids")
    every = scan.filter("start < 0").select(*key, F.col("n_words").cast("long").alias("n_words"))
    out = every.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))
