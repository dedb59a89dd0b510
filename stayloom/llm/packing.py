"""Mixture-controlled packing: every window of WIDTH tokens holds the sources in their target proportions.

Each source is a queue of tokens. Deficit round-robin gives every queue, in every window, its share of the window plus
the fraction it is still owed, and carries what stays owed. That schedule has a closed form: the first T tokens of the
packed stream are the T smallest keys (2 i + 1) / weight over the i-th tokens of all queues, so that a queue is never
a token away from its share for long, the deficits of a window are known without walking through the windows before it,
and every task finds the cuts of its own documents alone. A queue that has run dry leaves its share to the others.

Steps: tokenize once and write the ids; add up tokens by task and queue, which gives every document its place in its
queue; cut each document where the windows of its queue end. Nothing but sums of (task, queue) is exchanged.

Queues are the values of the source column. Beyond MAX_QUEUES values, sources with a given weight and the largest ones
(by bytes of text) keep a queue of their own; only the tail is grouped, by crc32, into the quarter of the queues that is
left for it, or fewer where given weights need them. A group has the weight of its sources together. No row is left out.
The default weights are the token counts, so that all queues last to the end.

Defined results: a null text is the closing id alone, a null source is a queue of its own, rows that repeat a
``doc_id`` are packed one by one, an empty table gives no pieces. Other columns of the input are ignored. Only the last
window may hold fewer than WIDTH tokens.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat
from operator import attrgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import text_batches, utf8

WIDTH, CLOSING_ID, MAX_QUEUES = 2048, 1, 256
#: Rows of the table of (task, queue) sums up to which it is broadcast; beyond that it is joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Words of one generation of the cache, of which a worker holds two, and bytes of text worked on at once: together with
#: the tokenizer they are what a worker needs, and an executor has a worker for each core.
_CACHED_WORDS, _BYTES_AT_ONCE = 400_000, 3 << 20
_LEARNED = 50_000
#: Numbers (windows times queues) of cuts that are worked out at once.
_CUTS = 1 << 20

TOKENS = "doc_id long, queue int, part int, place long, n long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "queue int")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Splitting patterns that take a run of letters as one piece, a full stop or comma apart from letters and digits, and
#: no white space. (Fixed values: patterns of public vocabularies.)
_LETTER_RUNS = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
#: Letters before this code point are lower-cased one by one and have no other normal form.
_FURTHER = "\u0250"


class Shortcuts(NamedTuple):
    """What a tokenizer's own description proves. ``words``: its tokens never cross white space, so a text has the ids
    of its words. ``lower``: upper and lower case have the same ids. ``letters``: a word of letters is one piece for the
    model; a full stop or comma behind a letter or digit is a piece of its own."""

    words: bool
    lower: bool
    letters: bool
    bytewise: bool


def shortcuts(description: dict) -> Shortcuts:
    """Anything not known to be harmless proves nothing, and texts are then encoded whole."""
    def steps(part: dict | None, name: str) -> list[dict]:
        if part is None:
            return []
        return [x for inner in part[name] for x in steps(inner, name)] if part["type"] == "Sequence" else [part]

    folds = steps(description.get("normalizer"), "normalizers")
    harmless = all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["content"] == " "
                   and x["pattern"] == {"Regex": r"\s+"} for x in folds)
    cuts = steps(description.get("pre_tokenizer"), "pretokenizers")
    plain = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"]
                for t in description.get("added_tokens") or [])
    known = bool(cuts) and cuts[0]["type"] == "Split" and cuts[0]["pattern"].get("Regex") in _LETTER_RUNS and (
        cuts[0]["behavior"] == "Removed" and cuts[0]["invert"])
    bytewise = cuts[1:] and cuts[1]["type"] == "ByteLevel" and not (
        cuts[1]["use_regex"] or cuts[1]["add_prefix_space"])
    letters = harmless and plain and known and (len(cuts) == 1 or len(cuts) == 2 and bytewise)
    words = letters or harmless and plain and len(cuts) == 1 and cuts[0]["type"] in ("WhitespaceSplit", "Whitespace")
    return Shortcuts(bool(words), bool(words) and any(x["type"] == "Lowercase" for x in folds), bool(letters),
                     bool(bytewise))


def _lowered(texts: pa.Array) -> pa.Array:
    """Fewer different words are left. Texts with marks of special tokens keep their case, as do those they share a
    batch with."""
    if pc.any(pc.match_substring(texts, "<|")).as_py():
        return texts
    data, offsets = utf8(texts)
    low = _LOWER[data[offsets[0]:offsets[-1]]] if len(texts) else data
    ends = np.ascontiguousarray(offsets - offsets[0])
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(low)])


def _letters_of_bytes() -> dict[int, str]:
    """The visible character that byte-level vocabularies write for each byte: itself, or the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class WordCache:
    """Ids of texts from the ids of their words, where the tokenizer's description allows it; else of whole texts.

    Most words are seen before, so they cost a dictionary lookup for each batch they are in. New words of letters go to
    the model at once, other new words through all steps of the tokenizer. A full cache is kept as the older generation
    while a new one fills, so that words in use are taken over and only rare ones are forgotten.
    """

    def __init__(self, vocabulary: str, closing_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.closing_id = Tokenizer.from_file(vocabulary), closing_id
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.takes = shortcuts(json.loads(self.tokenizer.to_str()))
        self.shown = _letters_of_bytes()
        self._begin()
        self.older = self.number, self.ids, self.starts, self.lengths

    def _begin(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.array([self.closing_id], np.uint32)
        self.starts, self.lengths = np.zeros(1, np.int64), np.ones(1, np.int64)  # entry 0: the closing id

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def _piece(self, word: str) -> str | None:
        """What the model is given for a word of letters; None for other words."""
        if not self.takes.letters or not word.isalpha():
            return None
        if self.takes.lower and not word.islower():
            word = word.lower()
        if word.isascii():
            return word
        if max(word) >= _FURTHER or not word.isalpha():
            return None
        return word.encode().decode("latin-1").translate(self.shown) if self.takes.bytewise else word

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), _LEARNED):
            mine = words[at:at + _LEARNED]
            pieces = list(map(self._piece, mine))
            short = [(w, p) for w, p in zip(mine, pieces) if p is not None]
            rest = [w for w, p in zip(mine, pieces) if p is None]
            tokens = list(map(self.tokenizer.model.tokenize, [p for _, p in short]))
            others = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            ids = chain(map(attrgetter("id"), chain.from_iterable(tokens)), chain.from_iterable(others))
            self._add([w for w, _ in short] + rest, np.fromiter(ids, np.uint32),
                      np.fromiter(map(len, chain(tokens, others)), np.int64, len(mine)))

    def _recall(self, words: list[str]) -> list[str]:
        """Take over what the older generation knows; the other words are returned."""
        number, ids, starts, lengths = self.older
        at = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
        known = at >= 0
        if known.any():
            counts = lengths[at[known]]
            before = np.cumsum(counts) - counts
            taken = ids[np.repeat(starts[at[known]] - before, counts) + np.arange(counts.sum())]
            self._add(list(compress(words, known.tolist())), taken, counts)
        return list(compress(words, (~known).tolist()))

    def _numbers(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self.number) + len(new) > _CACHED_WORDS:
                self.older = self.number, self.ids, self.starts, self.lengths
                self._begin()
                new = np.arange(len(words))
            fresh = [words[k] for k in new.tolist()]
            self._learn(self._recall(fresh))
            numbers[new] = np.fromiter(map(self.number.__getitem__, fresh), np.int64, len(fresh))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, each closed by the closing id, and the n + 1 offsets into them."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.takes.words:
            return self._encode_whole(texts)
        if self.takes.lower:
            texts = _lowered(texts)
        if self.takes.letters:  # a full stop or comma is a piece of its own with or without a blank before it
            texts = pc.replace_substring_regex(texts, r"([a-z0-9])([.,])([ \n])", r"\1 \2\3")
        words = pc.ascii_split_whitespace(texts)
        ends = np.asarray(words.offsets).astype(np.int64)
        base = ends[0]
        flat = words.values[base:ends[-1]].dictionary_encode()
        numbers = self._numbers(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = numbers[np.asarray(flat.indices)] if len(flat) else np.empty(0, np.int64)
        at = np.insert(at, ends[1:] - base, 0)
        lengths = self.lengths[at]
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = self.ids[np.repeat(self.starts[at] - before, lengths) + np.arange(total)]
        closing = ends[1:] - base + np.arange(len(texts))
        return ids, np.concatenate([[0], before[closing] + 1])


    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        closing = np.array([self.closing_id], np.uint32)
        found = [np.append(np.array(self.tokenizer.encode(t.as_py(), add_special_tokens=False).ids, np.uint32), closing)
                 for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)]).astype(np.int64)
        return np.concatenate(found) if found else closing[:0], offsets


_caches: dict[tuple, WordCache] = {}


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches together, so that a word is looked up once for more text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _BYTES_AT_ONCE:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _tokenize(vocabulary: str, closing_id: int, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        cache = _caches.setdefault((vocabulary, closing_id), None) or WordCache(vocabulary, closing_id)
        _caches[vocabulary, closing_id] = cache
        filled: dict[int, int] = {}
        for batch in _merged(batches):
            ids, offsets = cache.encode(batch.column("text"))
            counts = np.diff(offsets)
            places = []
            for queue, n in zip(batch.column("queue").to_pylist(), counts.tolist()):
                places.append(filled.get(queue, 0))
                filled[queue] = places[-1] + n
            raw = pa.py_buffer(np.ascontiguousarray(ids.astype(kind)))
            ends = pa.py_buffer((offsets * np.dtype(kind).itemsize).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("queue"), pa.array([part] * len(counts), pa.int32()),
                pa.array(places, pa.int64()), pa.array(counts, pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, raw])],
                names=["doc_id", "queue", "part", "place", "n", "ids"])
            del batch, ids, offsets, raw, ends
            pa.default_memory_pool().release_unused()  # else Arrow keeps the most that a batch has ever needed
    return run


class Schedule:
    """How many tokens of each queue stand before the end of a window."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, width: int):
        self.totals, self.weights, self.width = totals.astype(np.float64), weights.astype(np.float64), width
        self.tokens = int(totals.sum())
        self.windows = -(-self.tokens // width)
        # the fluid schedule is linear between the points where a queue runs dry
        dry = np.concatenate([[0.0], np.sort(2 * self.totals / self.weights)])
        self.dry = dry
        self.at_dry = np.minimum(self.totals, dry[:, None] * self.weights / 2).sum(axis=1)

    def cuts(self, windows: np.ndarray) -> np.ndarray:
        """Row for each w: tokens of every queue in the windows before w. Keys are compared as (key, queue)."""
        wanted = np.minimum(windows.astype(np.int64) * self.width, self.tokens).astype(np.float64)
        level = np.interp(wanted, self.at_dry, self.dry)
        have = np.clip(np.floor((level[:, None] * self.weights + 1) / 2), 0, self.totals)
        rows = np.arange(len(wanted))
        last = len(self.totals) - 1
        while True:
            following = np.where(have < self.totals, (2 * have + 1) / self.weights, np.inf)
            held = np.where(have > 0, (2 * have - 1) / self.weights, -np.inf)
            add, drop = following.argmin(axis=1), last - held[:, ::-1].argmax(axis=1)
            short = wanted - have.sum(axis=1)
            first, latest = following[rows, add], held[rows, drop]
            swap = (short == 0) & ((latest > first) | ((latest == first) & (drop > add)))
            more, less = (short > 0) | swap, (short < 0) | swap
            if not (more.any() or less.any()):
                return have.astype(np.int64)
            have[rows[more], add[more]] += 1
            have[rows[less], drop[less]] -= 1

    def windows_of(self, queue: int, places: np.ndarray) -> np.ndarray:
        """The windows that hold the given tokens of a queue: a guess from the fluid schedule, then stepwise."""
        found = []
        for at in range(0, len(places), self._rows):
            mine = places[at:at + self._rows]
            level = (2 * mine + 1) / self.weights[queue]
            before = np.clip(np.floor((level[:, None] * self.weights + 1) / 2), 0, self.totals).sum(axis=1) - 1
            window = np.clip(before // self.width, 0, self.windows - 1).astype(np.int64)
            while True:
                low, high = self.cuts(window)[:, queue], self.cuts(window + 1)[:, queue]
                step = (mine >= high).astype(np.int64) - (mine < low)
                if not step.any():
                    break
                window += step
            found.append(window)
        return np.concatenate(found)

    def ends_of(self, queue: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the queue before and up to the end of each window, and what earlier queues fill of it."""
        parts = []
        for at in range(0, len(windows), self._rows):
            low, high = self.cuts(windows[at:at + self._rows]), self.cuts(windows[at:at + self._rows] + 1)
            parts.append((low[:, queue], high[:, queue], (high[:, :queue] - low[:, :queue]).sum(axis=1)))
        return tuple(np.concatenate(p) for p in zip(*parts))

    @property
    def _rows(self) -> int:
        return max(_CUTS // len(self.totals), 1)

    def touched(self, queue: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Windows with tokens of documents that lie at ``low`` to ``high`` of the queue: all between the first and the
        last of a document, or, where these are more than its tokens, those of its tokens."""
        first, final = self.windows_of(queue, low), self.windows_of(queue, high - 1)
        dense = final - first < high - low + 16
        found = [np.unique(np.concatenate([first, final]))]

        def counted(starts, ends):
            sizes = ends - starts
            return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())

        found.append(counted(first[dense], final[dense] + 1))
        for a, b in zip(low[~dense].tolist(), high[~dense].tolist()):
            found.append(self.windows_of(queue, np.arange(a, b)))
        return np.unique(np.concatenate(found))


def _pieces(totals: np.ndarray, weights: np.ndarray, width: int, kind: str) -> Callable:
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(totals, weights, width)
        for batch in batches:
            queues = np.asarray(batch.column("queue"))
            begins = np.asarray(batch.column("place")) + np.asarray(batch.column("before"))
            counts = np.asarray(batch.column("n"))
            ids, offsets = batch.column("ids").buffers()[2], batch.column("ids")
            data = np.frombuffer(ids, np.uint8)
            bounds = np.frombuffer(offsets.buffers()[1], np.int32)[offsets.offset:offsets.offset + len(offsets) + 1]
            doc_ids = batch.column("doc_id")
            found = []
            for queue in np.unique(queues):
                mine = np.flatnonzero(queues == queue)
                mine = mine[np.argsort(begins[mine], kind="stable")]
                low, high = begins[mine], begins[mine] + counts[mine]
                windows = schedule.touched(int(queue), low, high)
                begin, end, lead = schedule.ends_of(int(queue), windows)
                # a piece starts where a document or a window of the queue does
                starts = np.unique(np.concatenate([low, begin[(begin > low[0]) & (begin < high[-1])]]))
                doc = np.searchsorted(low, starts, "right") - 1
                inside = starts < high[doc]
                starts, doc = starts[inside], doc[inside]
                at = np.searchsorted(begin, starts, "right") - 1
                ends = np.minimum(high[doc], end[at])
                found.append(np.stack([mine[doc], starts - low[doc], ends - starts, windows[at],
                                       lead[at] + starts - begin[at], np.full(len(starts), queue)]))
            row, start, length, window, offset, queue = np.concatenate(found, axis=1)
            size = np.dtype(kind).itemsize
            heads = bounds[row].astype(np.int64) + start * size
            tails = heads + length * size
            if size == 4:
                sums = [zlib.crc32(data[a:b]) for a, b in zip(heads.tolist(), tails.tolist())]
            else:
                wide = data[bounds[0]:bounds[-1]].view(kind).astype("<u4").view(np.uint8)
                heads, tails = (heads - bounds[0]) * 4 // size, (tails - bounds[0]) * 4 // size
                sums = [zlib.crc32(wide[a:b]) for a, b in zip(heads.tolist(), tails.tolist())]
            yield pa.RecordBatch.from_arrays([
                doc_ids.take(pa.array(row)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                pa.array(counts[row]), pa.array(window), pa.array(offset), pa.array(queue.astype(np.int32))],
                names=names)
    return run


#: Stands for the name of a queue of several sources.
_GROUP = object()


def _own_queues(docs: DataFrame, source: Column, text: Column, weights: dict[str | None, float],
                max_queues: int) -> tuple[list[str | None], int]:
    """Sources that keep a queue of their own where there are too many, and the number of groups for the others."""
    sized = docs.select(source.alias("source"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias(
        "n")).groupBy("source").agg(F.sum("n").alias("n"))
    wanted = F.col("source").isin([n for n in weights if n is not None])
    given = F.coalesce(wanted, F.lit(None in weights))  # a null source
    names = [r.source for r in sized.filter(given).select("source").collect()]  # one for each weight at most
    if len(names) >= max_queues:
        raise ValueError(f"{len(names)} sources have weights, {max_queues} queues leave none for the others")
    groups = min(max(max_queues // 4, 1), max_queues - len(names))
    largest = sized.filter(~given).orderBy(F.desc("n"), "source").limit(max_queues - groups - len(names))
    return names + [r.source for r in largest.collect()], groups  # max_queues at most


def pack(docs: DataFrame, vocabulary: str, width: int = WIDTH, closing_id: int = CLOSING_ID,
         weights: dict[str | None, float] | None = None, max_queues: int = MAX_QUEUES, id_column: str = "doc_id",
         text_column: str = "text", source_column: str = "source",
         broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue``.

    ``weights`` gives target proportions by source; what it leaves out gets its token count times the scale of the
    given ones. A source of weight 0 or less is not allowed, as every token has to be placed; nor are more sources with
    weights than queues, with one for the rest.
    """
    from tokenizers import Tokenizer

    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be above 0")
    spark = docs.sparkSession
    text_batches(spark)
    kind = "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"
    source = F.col(source_column).cast("string")
    names = [r[0] for r in docs.select(source).distinct().limit(max_queues + 1).collect()]  # max_queues + 1 at most
    groups = 0
    if len(names) > max_queues:
        names, groups = _own_queues(docs, source, F.col(text_column), weights or {}, max_queues)
    names.sort(key=lambda n: (n is not None, n or ""))
    listed = F.array(*(F.lit(n) for n in names if n is not None)).cast("array<string>")
    shift = int(None in names)
    place = F.array_position(listed, source).cast("int")  # 0: in the tail
    if groups:
        hashed = F.pmod(F.crc32(F.coalesce(source, F.lit("")).cast("binary")), F.lit(groups)).cast("int") + len(names)
        queue = F.when(source.isNull(), F.lit(0) if shift else hashed).when(place > 0, place - 1 + shift).otherwise(hashed)
    else:
        queue = F.when(source.isNull(), F.lit(0)).otherwise(place - 1 + shift) if names else F.lit(0)
    names = names + [_GROUP] * groups
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), queue.cast("int").alias("queue"),
                       F.col(text_column).alias("text"))
    tokens = staged(rows.mapInArrow(_tokenize(vocabulary, closing_id, kind), TOKENS), "token-ids")
    sums = staged(tokens.groupBy("part", "queue").agg(F.max(F.col("place") + F.col("n")).alias("n")), "queue-sums")
    totals = np.zeros(max(len(names), 1), np.int64)
    for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect():  # a row for each queue, max_queues at most
        totals[r.queue] = r.n
    if not totals.sum():
        return spark.createDataFrame([], PIECES)
    from pyspark.sql import Window as W

    before = sums.select("part", "queue", F.coalesce(F.sum("n").over(
        W.partitionBy("queue").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    before = F.broadcast(before) if sums.count() <= broadcast_rows else before
    live = np.flatnonzero(totals)  # a group of sources may be empty
    shares = totals[live].astype(float) / totals.sum()
    if weights:
        given = [(k, names[q]) for k, q in enumerate(live) if names[q] in weights]
        scale = sum(weights[n] for _, n in given) / sum(shares[k] for k, _ in given) if given else 1.0
        shares = shares * scale
        for k, name in given:
            shares[k] = weights[name]
    if len(live) < len(totals):
        number = F.array_position(F.array(*(F.lit(int(q)) for q in live)), F.col("queue")).cast("int") - 1
    else:
        number = F.col("queue")
    placed = tokens.join(before, ["part", "queue"]).select(
        "doc_id", number.alias("queue"), "place", "before", "n", "ids")
    return placed.mapInArrow(_pieces(totals[live], shares, width, kind), PIECES)
