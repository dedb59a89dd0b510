"""Toxicity by non-negative positive-unlabelled learning, in numpy.

Confirmed toxic documents are the positives. The unlabelled text is drawn from all documents, so it holds toxic ones too. The
classifier minimises the risk estimate

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

in which the unlabelled part is corrected by the class prior. Where a step makes the corrected part negative, that part
is driven back up instead (the positives it was corrected by have been over-fitted).

A text is read as runs of letters, lower-cased (A-Z). A word's features are itself and its beginnings of 4, 5 and 6
bytes, hashed to FEATURES values, so that inflected and derived forms count as well. A document's margin is a linear
function of how often each feature comes up per word, so it does not depend on the length of the text. Features that
fewer than LEAST_DOCUMENTS confirmed documents have are left out, and weights are drawn to zero.

Training is on the driver, over a bounded sample: at most SAMPLE_POSITIVE confirmed and SAMPLE_UNLABELLED arbitrary documents,
chosen by the hash of their id among documents of at most SAMPLE_CHARS code points. Scoring reads every whole text.

Defined results: a text without a letter (null, empty) has a margin of its own, the bias. Without confirmed documents
nothing can be learned and every score is the class prior. Rows that repeat an id are scored one by one; a document is
confirmed if any label row says so. An empty table gives an empty result. Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, utf8
from .shingles import SpanHashes, runs_of

SAMPLE_POSITIVE, SAMPLE_UNLABELLED, SAMPLE_CHARS = 1500, 5000, 8192
BITS, BEGINNINGS, LEAST_DOCUMENTS = 20, (4, 5, 6), 2
FEATURES = 1 << BITS
#: A feature's value is its count per PER_WORDS words; EXTRA_WORDS are added so that no word decides alone in a short text.
PER_WORDS, EXTRA_WORDS = 50, 10
STEPS, BATCH, RATE, DECAY = 1500, 256, 0.5, 3e-4
#: The sign of the corrected part is judged on its running mean over batches, and steps back are shortened.
SMOOTH, GAMMA = 0.95, 0.1

SCORES = "doc_id long, score double"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTES_AT_ONCE = 4 << 20


class Classifier(NamedTuple):
    weights: np.ndarray  # FEATURES and a zero for beginnings that a short word does not have
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word (words, 1 + beginnings) and the number of words before each text."""
    begin, end = runs_of(_LETTER[data], offsets)
    spans = SpanHashes(data)
    shift = np.uint64(64 - BITS)
    found = [(spans.of(begin, end) >> shift).astype(np.int64)]
    for n in BEGINNINGS:
        long = end - begin > n
        found.append(np.full(len(begin), FEATURES, np.int64))
        found[-1][long] = (spans.of(begin[long], begin[long] + n) * np.uint64(2 * n + 1) >> shift).astype(np.int64)
    return np.stack(found, axis=1), np.searchsorted(begin, offsets)


def score(model: Classifier, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability for each text."""
    margins, at = np.full(len(offsets) - 1, float(model.bias)), 0
    while at < len(margins):  # so many texts that their bytes fit, or a single long one
        to = max(int(np.searchsorted(offsets, offsets[at] + _BYTES_AT_ONCE, "right")) - 1, at + 1)
        found, words = features(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        summed = np.concatenate([[0.0], np.cumsum(model.weights[found].sum(axis=1), dtype=np.float64)])
        margins[at:to] += PER_WORDS * (summed[words[1:]] - summed[words[:-1]]) / (np.diff(words) + EXTRA_WORDS)
        at = to
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def _rows(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and their values for each text."""
    rows = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        found, _ = features(data, np.array([0, len(data)]))
        names, counts = np.unique(found[found < FEATURES], return_counts=True)
        rows.append((names, (PER_WORDS * counts / (len(found) + EXTRA_WORDS)).astype(np.float32)))
    return rows


def train(positive: list[bytes], unlabelled: list[bytes], prior: float, steps: int = STEPS, seed: int = 11,
          least_documents: int = LEAST_DOCUMENTS) -> Classifier:
    """Fit by Adagrad on batches, half of them confirmed; the pull to zero is proximal, so useless weights are zero."""
    weights, bias = np.zeros(FEATURES + 1, np.float32), float(np.log(prior / (1 - prior)))
    positive = list(dict.fromkeys(positive))  # copies would pass for evidence
    if not positive or not unlabelled:
        return Classifier(weights, bias)
    rng = np.random.default_rng(seed)
    rows = _rows(positive + unlabelled)
    n_p, half = len(positive), BATCH // 2
    seen = np.bincount(np.concatenate([r[0] for r in rows[:n_p]]), minlength=FEATURES)
    used = seen >= min(least_documents, n_p)
    rows = [(names[k], values[k]) for names, values in rows for k in [used[names]]]
    squares, bias_square = np.full(FEATURES + 1, 1e-4, np.float32), 1e-4
    done, corrected = 0, 0.0
    while done < steps:
        order = rng.permutation(np.arange(n_p, len(rows)))
        for at in range(0, len(order), half):
            done += 1
            part = np.concatenate([rng.integers(n_p, size=half), order[at:at + half]])
            sizes = [len(rows[k][0]) for k in part]
            names = np.concatenate([rows[k][0] for k in part])
            values = np.concatenate([rows[k][1] for k in part])
            row = np.repeat(np.arange(len(part)), sizes)
            margins = np.bincount(row, weights[names] * values, len(part)) + bias
            up = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))  # slope of loss(-); that of loss(+) is up - 1
            n_u = len(part) - half
            loss_negative = np.logaddexp(0, margins)
            risk = loss_negative[half:].mean() - prior * loss_negative[:half].mean()
            corrected = risk if done == 1 else SMOOTH * corrected + (1 - SMOOTH) * risk
            if corrected >= 0:
                slope = np.concatenate([prior * (up[:half] - 1) / half - prior * up[:half] / half, up[half:] / n_u])
            else:
                slope = GAMMA * np.concatenate([prior * up[:half] / half, -up[half:] / n_u])
            gradient = np.bincount(names, slope[row] * values, FEATURES + 1)
            at_work = np.unique(names)
            g = gradient[at_work].astype(np.float32)
            squares[at_work] += g * g
            step = RATE / np.sqrt(squares[at_work])
            moved = weights[at_work] - step * g
            weights[at_work] = np.sign(moved) * np.maximum(np.abs(moved) - step * DECAY, 0)
            bias_square += slope.sum() ** 2
            bias -= RATE * slope.sum() / np.sqrt(bias_square)
    return Classifier(weights, bias)


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic", sample_positive: int = SAMPLE_POSITIVE,
        sample_unlabelled: int = SAMPLE_UNLABELLED, sample_chars: int = SAMPLE_CHARS) -> Classifier:
    """Train from the documents given; only confirmed toxic rows of ``labels`` are used as labels of single documents.

    The class prior is the share of toxic rows among the labels, unless it is given.
    """
    marks = labels.select(F.col(id_column).cast("long").alias("_id"), F.col(label_column).alias("_toxic"))
    marks = marks.join(docs.select(F.col(id_column).cast("long").alias("_id")).distinct(), "_id", "left_semi")
    if prior is None:
        share = marks.agg(F.avg("_toxic").alias("p"), F.count("_toxic").alias("n")).first()
        prior = share.p if share.n else 0.1
    prior = min(max(float(prior), 0.01), 0.9)
    known = marks.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).filter("_toxic = 1").select("_id")
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("text")).filter(
        F.char_length("text").between(1, sample_chars))
    # the unlabelled part is drawn from all documents, confirmed ones included: that is what the prior is a share of
    order = [F.xxhash64(F.col("_id").cast("string")), F.col("_id")]
    ids = texts.select("_id").distinct()
    drawn = [ids.join(known, "_id", "left_semi").orderBy(*order).limit(sample_positive),
             ids.orderBy(*order).limit(sample_unlabelled)]
    chosen = drawn[0].select("_id", F.lit(True).alias("positive")).unionByName(
        drawn[1].select("_id", F.lit(False).alias("positive")))  # at most the two sample sizes
    rows = texts.join(F.broadcast(chosen), "_id").dropDuplicates(["_id", "positive"]).orderBy(
        "_id", "positive").collect()
    return train([r.text.encode() for r in rows if r.positive], [r.text.encode() for r in rows if not r.positive],
                 prior)


def _scorer(model: Classifier) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score(model, *utf8(batch.column("text"))), pa.float64())],
                names=["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, model: Classifier, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_scorer(model), SCORES)
