"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Texts are read as UTF-8 in segments of SEGMENT bytes; both directions start anew in each segment. The network gives a
distribution over the languages at every byte. A document's probabilities are the mean over all of its bytes, and the
share of bytes labelled with each language is returned as well.

Training is backpropagation through time on the driver, over a bounded sample: at most SAMPLE_DOCS labelled documents
per language, chosen by the hash of their id, of each SAMPLE_CHARS code points from a place that the same hash chooses.
Every byte of a sample carries the language of its document. The result is the same for the same rows. The languages
take turns in the BATCH places of a step; steps and states grow with their number, by PER_STEP languages, and the texts
read at once shrink with it. The sample, and with it the driver's memory, grows with the number of languages.

Defined results: ``und`` with score 0 where the text is null or has no letter, and everywhere if no document with a
label can be learned from. Rows that repeat an id are labelled one by one. An empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_batches, utf8

SAMPLE_DOCS, SAMPLE_CHARS = 150, 1500
HIDDEN, SEGMENT, LANES = 8, 256, 2048
STEPS, BATCH, LENGTH, RATE = 240, 96, 80, 0.02
#: Languages for which STEPS and HIDDEN are meant; more of them get multiples.
PER_STEP = 24

LABELS = "doc_id long, lang_pred string, score double, shares array<float>"
UNKNOWN = "und"


class Network(NamedTuple):
    """Weights of one direction hold the update gate, the reset gate and the candidate, in this order."""

    languages: list[str]
    inputs: list[np.ndarray]  # for each direction: (3 hidden, 256), what each byte adds, bias included
    states: list[np.ndarray]  # (3 hidden, hidden)
    out: list[np.ndarray]  # (languages, hidden)
    bias: np.ndarray


def _times(languages: int) -> int:
    return -(-languages // PER_STEP)


def _turns(step: int, languages: int) -> np.ndarray:
    """The language of each of the BATCH places of a step, from step 1."""
    return (np.arange(BATCH) + (step - 1) * BATCH) % languages


def _start(languages: list[str], rng: np.random.Generator) -> Network:
    def some(scale, *shape):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    n = len(languages)
    hidden = HIDDEN * _times(n)
    return Network(languages, [some(0.3, 3 * hidden, 256) for _ in "fb"],
                   [some(0.4, 3 * hidden, hidden) for _ in "fb"], [some(0.3, n, hidden) for _ in "fb"],
                   np.zeros((n, 1), np.float32))


def _forward(codes: np.ndarray, inputs: np.ndarray, states: np.ndarray) -> list[tuple]:
    """Gates and states of each step, for training. ``codes``: (steps, lanes) in reading order."""
    hidden = states.shape[1]
    h, steps = np.zeros((hidden, codes.shape[1]), np.float32), []
    for x in codes:
        added, kept = inputs[:, x], states @ h
        gates = 1 / (1 + np.exp(-(added[:2 * hidden] + kept[:2 * hidden])))
        update, reset = gates[:hidden], gates[hidden:]
        candidate = np.tanh(added[2 * hidden:] + reset * kept[2 * hidden:])
        steps.append((h, update, reset, candidate, kept[2 * hidden:]))
        h = h + update * (candidate - h)
    steps.append((h,))
    return steps


def _backward(codes: np.ndarray, steps: list[tuple], states: np.ndarray, errors: np.ndarray) -> tuple:
    """Gradients of the input table and the state weights from the errors at the states after each step."""
    d_inputs = np.zeros((256, len(states)), np.float32)
    d_states = np.zeros_like(states)
    d_h = np.zeros_like(steps[0][0])
    for t in range(len(codes) - 1, -1, -1):
        h, update, reset, candidate, kept = steps[t]
        d_h = d_h + errors[t]
        d_candidate = d_h * update * (1 - candidate * candidate)
        d_update = d_h * (candidate - h) * update * (1 - update)
        d_reset = d_candidate * kept * reset * (1 - reset)
        local = np.concatenate([d_update, d_reset, d_candidate])
        through = np.concatenate([d_update, d_reset, d_candidate * reset])
        np.add.at(d_inputs, codes[t], local.T)
        d_states += through @ h.T
        d_h = d_h * (1 - update) + states.T @ through
    return d_inputs.T, d_states


def _probabilities(logits: np.ndarray, axis: int) -> np.ndarray:
    logits = np.exp(logits - logits.max(axis=axis, keepdims=True))
    return logits / logits.sum(axis=axis, keepdims=True)


def train(texts: list[bytes], labels: list[str], steps: int | None = None, seed: int = 7) -> Network | None:
    """Fit by Adam. Each step reads LENGTH bytes from BATCH places, with the languages in equal parts.

    ``steps`` is STEPS by default, a multiple of it beyond PER_STEP languages.
    """
    languages = sorted(set(labels))
    if not languages:
        return None
    steps = STEPS * _times(len(languages)) if steps is None else steps
    rng = np.random.default_rng(seed)
    pools = [[np.frombuffer(t, np.uint8) for t, lang in zip(texts, labels) if lang == name and t]
             for name in languages]
    pools = [p or [np.zeros(1, np.uint8)] for p in pools]
    net = _start(languages, rng)
    weights = [*net.inputs, *net.states, *net.out, net.bias]
    mean, spread = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        truth = _turns(step, len(languages))
        codes = np.zeros((LENGTH, BATCH), np.int64)
        for lane, lang in enumerate(truth):
            text = pools[lang][rng.integers(len(pools[lang]))]
            at = rng.integers(max(len(text) - LENGTH, 0) + 1)
            piece = text[at:at + LENGTH]
            codes[:, lane] = np.resize(piece, LENGTH)  # a short text is read again
        order = [codes, codes[::-1]]
        runs = [_forward(c, net.inputs[k], net.states[k]) for k, c in enumerate(order)]
        after = [np.stack([s[0] for s in run[1:]]) for run in runs]  # (steps, HIDDEN, lanes) in reading order
        after[1] = after[1][::-1]
        logits = net.out[0] @ after[0] + net.out[1] @ after[1] + net.bias
        error = _probabilities(logits, 1)
        error[:, truth, np.arange(BATCH)] -= 1
        error /= LENGTH * BATCH
        d_out = [np.einsum("tcl,thl->ch", error, a) for a in after]
        back = [net.out[k].T @ error for k in range(2)]
        back[1] = back[1][::-1]
        grads = [_backward(order[k], runs[k], net.states[k], back[k]) for k in range(2)]
        d_weights = [g[0] for g in grads] + [g[1] for g in grads] + d_out + [error.sum(axis=(0, 2))[:, None]]
        rate = RATE * min(1.0, 2.0 * (1 - (step - 1) / steps))
        for w, d, m, v in zip(weights, d_weights, mean, spread):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def _read(codes: np.ndarray, active: list[int], inputs: np.ndarray, states: np.ndarray, backwards: bool,
          out: np.ndarray, logits: np.ndarray) -> None:
    """Add one direction's part of the logits (steps, languages, lanes).

    Lanes come with the longest first; step t has ``active[t]`` of them. sigmoid(x) is (tanh(x / 2) + 1) / 2.
    """
    hidden = states.shape[1]
    halves = np.ones((3 * hidden, 1), np.float32)
    halves[:2 * hidden] = 0.5
    inputs, states = np.ascontiguousarray(inputs * halves), np.ascontiguousarray(states * halves)
    h = np.zeros((hidden, codes.shape[1]), np.float32)
    steps = range(len(active) - 1, -1, -1) if backwards else range(len(active))
    for t in steps:
        n = active[t]
        mine = h[:, :n] if n < codes.shape[1] else h
        added, kept = np.take(inputs, codes[t, :n], axis=1), states @ mine
        gates = added[:2 * hidden]
        gates += kept[:2 * hidden]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        candidate, rest = added[2 * hidden:], kept[2 * hidden:]
        rest *= gates[hidden:]
        candidate += rest
        np.tanh(candidate, out=candidate)
        candidate -= mine
        candidate *= gates[:hidden]
        mine += candidate
        logits[t, :, :n] += out @ mine


def label(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, its mean probabilities and the share of its bytes labelled with each language."""
    n, c = len(offsets) - 1, len(net.languages)
    pooled, shares = np.zeros((n, c)), np.zeros((n, c))
    sizes = np.diff(offsets)
    per = -(-sizes // SEGMENT)
    doc = np.repeat(np.arange(n), per)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    starts = offsets[:-1][doc] + number * SEGMENT
    lengths = np.minimum(SEGMENT, sizes[doc] - number * SEGMENT)
    order = np.argsort(-lengths, kind="stable")
    room = max(LANES * 4 // max(c, 4), 16)  # the logits of a segment hold every language
    for at in range(0, len(order), room):
        lanes = order[at:at + room]
        length, longest = lengths[lanes], int(lengths[lanes[0]])
        places = starts[lanes][None, :] + np.minimum(np.arange(longest)[:, None], length[None, :] - 1)
        codes = data[places].astype(np.intp)
        active = (length[None, :] > np.arange(longest)[:, None]).sum(axis=1).tolist()
        logits = np.zeros((longest, c, len(lanes)), np.float32) + net.bias
        for k in range(2):
            _read(codes, active, net.inputs[k], net.states[k], bool(k), net.out[k], logits)
        valid = (np.arange(longest)[:, None] < length[None, :])[:, None, :]
        best = (logits == logits.max(axis=1, keepdims=True)) & valid
        np.add.at(shares, doc[lanes], best.sum(axis=0).T)
        np.add.at(pooled, doc[lanes], (_probabilities(logits, 1) * valid).sum(axis=0, dtype=np.float64).T)
    return pooled / np.maximum(sizes, 1)[:, None], shares / np.maximum(sizes, 1)[:, None]


def _labeller(net: Network | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            names, scores, shares = [UNKNOWN] * n, np.zeros(n), [None] * n
            if net is not None and n:
                has_letter = np.asarray(batch.column("has_letter").to_pylist(), bool)
                pooled, part = label(net, *utf8(batch.column("text")))
                best = pooled.argmax(axis=1)
                names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
                scores = np.where(has_letter, np.clip(pooled[np.arange(n), best], 0, 1), 0.0)
                shares = part.astype(np.float32).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(shares, pa.list_(pa.float32()))], names=["doc_id", "lang_pred", "score", "shares"])
    return run


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Network | None:
    """Train on a bounded sample of the rows given; rows without a language or a letter are left out."""
    text, key = F.col(text_column), F.xxhash64(F.col(id_column).cast("string"))
    usable = labelled.filter(F.col(lang_column).isNotNull() & has_letter(text))
    room = F.greatest(F.char_length(text) - sample_chars, F.lit(0)) + 1
    drawn = usable.select(F.col(lang_column).cast("string").alias("lang"), key.alias("key"), F.substring(
        text, F.pmod(key, room).cast("int") + 1, F.lit(sample_chars)).alias("piece"))
    # Spark prunes to the first rows of each language before the shuffle
    ranked = drawn.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("key", "piece")))
    rows = ranked.filter(F.col("place") <= sample_docs).orderBy("lang", "place").collect()  # bounded by sample_docs
    return train([r.piece.encode() for r in rows], [r.lang for r in rows])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, net: Network | None, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, shares`` of every document."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                       has_letter(F.col(text_column)).alias("has_letter"))
    return rows.mapInArrow(_labeller(net), LABELS)
