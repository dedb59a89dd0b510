"""SimHash near-duplicates by Golay-code fuzzy hashing.

1. A text's fingerprint has 64 bits: bit k is 1 where more than half of its shingle hashes have it. Documents of equal
   fingerprints form a class; everything below works on classes.
2. Two fingerprints that differ in two bits at most are equal in one of three segments, whichever bits differ
   (pigeonhole). The rest of the bits is then looked at through a window of 23: the binary Golay code of that length is
   perfect, so every word of 23 bits is decoded to one codeword, three errors away at most. Two words that differ in two
   bits have a word between them, one bit from either; all words one bit away from a given word decode to six codewords
   at most. So fingerprints that link have, for a segment, a key of its bits and one of these codewords in common.
3. A class is posted under the (up to 18) keys of its three segments. Keys that several classes have are joined; under
   each, the distances are verified and the edges of a spanning forest kept.
4. Near copies of one text can pile up under one key. Where more than BUCKET classes have a key, they are not compared
   with each other; instead each posts the words one bit away from it, and classes that have such a word in common are
   two bits apart at most. That is exact, needs no comparison, and is linear in the number of classes.
5. Components are contracted by joins on written tables.

Defined results: a text without words (or null) has the fingerprint zero, which is linked like any other. Rows that
repeat a ``doc_id`` are documents of their own under the same id. A row without ``doc_id`` takes the component that its
fingerprint belongs to; where no member of it has an id, the component is null. An empty table gives an empty result.
Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import text_batches
from .near import _connected

SHINGLE = 3
SEED = 42
#: Fingerprints link at this many differing bits; the keys are made for two.
DISTANCE = 2
#: Classes under a key that are compared with each other; beyond that, words between them are joined.
BUCKET = 512
#: Keys beyond BUCKET up to which their list is broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: First bit and number of bits of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code of length 23: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1. (A fixed value.)
GENERATOR = 0b101011100011
_LENGTH, _CHECKS = 23, 11
#: Bytes of a text that are hashed at once.
_BYTES = 1 << 18
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints ----------------------------------------------------------------------------------------------------

def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    at = 0
    while at < len(data):
        blank = _BLANK.search(data, at + _BYTES)
        to = blank.start() if blank else len(data)
        yield data[at:to].lower().split()  # of bytes, these know A-Z and ASCII white space only
        at = to


def fingerprint(data: bytes | None) -> int:
    """The 64 bits of a text in UTF-8."""
    words, n, counts, digest = [], 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for block in _word_blocks(data or b""):
        words += block
        if len(words) < SHINGLE:
            continue
        joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
        first = [0, *(ends[:-SHINGLE] + 1).tolist()]
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, ends[SHINGLE - 1:].tolist())], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int)
        n, words = n + len(hashes), words[1 - SHINGLE:]
    if not n:
        return digest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        prints = np.fromiter((fingerprint(t.as_py()) for t in texts), "<u8", batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))],
                                         names=["doc_id", "print"])


# --- keys ------------------------------------------------------------------------------------------------------------

@cache
def _leaders() -> np.ndarray:
    """The error pattern, of three bits at most, for each remainder of a division by the generator."""
    table, bits = np.zeros(1 << _CHECKS, np.int64), 1 << np.arange(_LENGTH)
    patterns = [np.zeros(1, np.int64), bits]
    for _ in range(2):
        more = (patterns[-1][:, None] | bits).reshape(-1)
        patterns.append(np.unique(more[more != np.repeat(patterns[-1], _LENGTH)]))
    for p in patterns:
        table[_remainder(p)] = p
    return table


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(_LENGTH - 1, _CHECKS - 1, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - _CHECKS), 0)
    return words


def nearby_codewords(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords that a word of 23 bits and its neighbours decode to: a row of 24, with repeats."""
    near = words[:, None] ^ np.append(0, 1 << np.arange(_LENGTH))
    remainders = _remainder(near)
    return (near ^ _leaders()[remainders]) >> _CHECKS  # the upper 12 bits of a codeword are its message


def segment_keys(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each segment, keys and the rows they are of: segment number, its bits, index of a codeword."""
    for number, (first, size) in enumerate(SEGMENTS):
        mask = (1 << size) - 1
        exact = (prints >> np.uint64(first) & np.uint64(mask)).astype(np.int64)
        # the bits after the segment, around the end
        turned = prints >> np.uint64((first + size) % 64)
        if first + size < 64:
            turned = turned | prints << np.uint64(64 - first - size)
        codes = np.sort(nearby_codewords((turned & np.uint64((1 << _LENGTH) - 1)).astype(np.int64)), axis=1)
        new = np.ones(codes.shape, bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        rows, places = np.nonzero(new)
        yield (number << 40 | exact[rows] << 12 | codes[rows, places]), rows


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.asarray(batch.column("print")).view(np.uint64)
        for at in range(0, len(prints), 1 << 14):
            part = prints[at:at + (1 << 14)]
            for keys, rows in segment_keys(part):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows].view(np.int64))],
                                                 names=["key", "print"])


# --- links -----------------------------------------------------------------------------------------------------------

def _forest(prints: np.ndarray) -> np.ndarray:
    """For each fingerprint the smallest index it is connected with, among a bounded number of them."""
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= DISTANCE
    label = np.arange(len(prints))
    while True:
        least = np.where(linked, label[None, :], len(prints)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, x, y = batch.column("prints"), [], []
        bounds, values = lists.offsets.to_pylist(), np.asarray(lists.values).view(np.uint64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            prints = values[a:b]
            to = _forest(prints)
            moved = to != np.arange(len(to))
            x.append(prints[moved])
            y.append(prints[to[moved]])
        x, y = (np.concatenate(v).view(np.int64) if v else np.empty(0, np.int64) for v in (x, y))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])


def _links(prints: DataFrame, bucket: int, broadcast_rows: int) -> DataFrame:
    """Pairs of different fingerprints, two bits apart at most, that connect all that such pairs connect."""
    posts = prints.mapInArrow(_post, "key long, print long")
    crowded = staged(posts.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > bucket)
                     .select(F.col("key").alias("_key")), "crowded")
    n = crowded.count()
    listed = F.broadcast(crowded) if n <= broadcast_rows else crowded
    quiet = posts.join(listed, F.col("key") == F.col("_key"), "left_anti") if n else posts
    shared = quiet.groupBy("key").agg(F.collect_list("print").alias("prints")).filter(F.size("prints") > 1)
    links = shared.select("prints").mapInArrow(_verify, "x long, y long")
    if n:
        heaped = posts.join(listed, F.col("key") == F.col("_key"), "left_semi").select("print").distinct()
        between = heaped.select("print", F.explode(_one_bit_away(F.col("print"))).alias("word"))
        least = staged(between.groupBy("word").agg(
            F.min("print").alias("y"), F.count("*").alias("m")).filter("m > 1").select(
            F.col("word").alias("_word"), "y"), "words")
        links = links.unionByName(between.join(least, F.col("word") == F.col("_word")).filter(
            F.col("print") != F.col("y")).select(F.col("print").alias("x"), "y"))
    return staged(links.distinct(), "links")


def _one_bit_away(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda k: F.when(k < 0, word).otherwise(
        word.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))))


def near_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET,
                      broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits)``, component_id``: the smallest id reachable over linked fingerprints."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    signed = staged(rows.mapInArrow(_sign, "doc_id long, print long"), "fingerprints")
    classes = staged(signed.groupBy("print").agg(F.min("doc_id").alias("min_doc")), "fingerprint-classes")
    components = _connected(classes.select(F.col("print").alias("cls"), F.col("print").alias("comp")),
                           _links(classes.select("print"), bucket, broadcast_rows))
    placed = classes.join(components, F.col("print") == F.col("cls"))
    names = placed.groupBy("comp").agg(F.min("min_doc").alias("component_id")).withColumnRenamed("comp", "_comp")
    of_class = staged(placed.join(names, F.col("comp") == F.col("_comp")).select(
        F.col("print").alias("_print"), "component_id"), "fingerprint-components")
    return signed.join(of_class, F.col("print") == F.col("_print")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
