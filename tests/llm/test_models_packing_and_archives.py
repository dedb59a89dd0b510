"""Packing, archives and the two trained classifiers, by round trip and held-out accuracy; then the pipeline."""

import gzip
import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stayloom.llm import language, packing, toxicity, warc
from stayloom.llm.common import crc32_of_id, table
from test_exact_and_near import SPACES, plain_near
from test_native_operators import plain_hits

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.01"


def direct(texts):
    encoded = Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 1] for e in encoded]


def test_word_cache_equals_the_tokenizer(spark):
    texts = ["", None, "  It's  3.14\n\tin Zürich ", "<|endoftext|> a<|startoftext|>b", "İΣ é  x",
             "a" * 3000, "\U0001f600‍x \x00 y\x1cz", "don't DON'T 'll''s"]
    texts += [r.text for r in table(spark, SMALL, "documents").limit(150).collect()]
    cache = packing.WordCache(VOCABULARY, 1)
    for _ in range(2):  # with an empty and with a filled cache
        ids, offsets = cache.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == direct(texts)


def test_a_full_word_cache_forgets_rare_words_only(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED_WORDS", 8)
    cache, learned = packing.WordCache(VOCABULARY, 1), []
    learn = cache._learn
    monkeypatch.setattr(cache, "_learn", lambda words: (learned.extend(words), learn(words)))
    for k in range(20):
        texts = ["the cat's Zürich", None, f"the word{k} x{k}y"]
        ids, offsets = cache.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == direct(texts)
        assert len(cache.number) <= 8 and len(cache.older[0]) <= 8
    assert learned.count("the") == 1 and learned.count("word3") == 1


def cased_vocabulary(folder):
    """Words of a list, told apart by case, cut at white space."""
    from tokenizers import models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[unk]": 0, "close": 1, "Word": 2, "word": 3, "word.": 4, ".": 5, "É": 6}, "[unk]"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = f"{folder}/cased.json"
    tokenizer.save(path)
    return path


@pytest.mark.parametrize("name", ["cased", "byte_bpe_50k.json"])
def test_other_vocabularies(tmp_path, name):
    path = cased_vocabulary(tmp_path) if name == "cased" else public_tokenizers.path(name)
    texts = ["Word word. x", None, "", "É é  word .\nWord. ", "a\u00a0b don't  DON'T 12.5, <|endoftext|>x", " lead", "t\t\tt "]
    cache = packing.WordCache(path, 1)
    assert not cache.takes.lower and cache.takes.words == (name == "cased")
    want = [[*e.ids, 1] for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):
        ids, offsets = cache.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_known_shortcuts():
    description = json.loads(Tokenizer.from_file(VOCABULARY).to_str())
    assert packing.shortcuts(description) == (True, True, True, True)
    lower = {"type": "Lowercase"}
    for part, value in [("normalizer", {"type": "Prepend", "prepend": "_"}), ("pre_tokenizer", None),
                        ("added_tokens", [{"normalized": True, "lstrip": False, "rstrip": False, "single_word": False}]),
                        ("normalizer", {"type": "Replace", "pattern": {"String": "a"}, "content": " "}),
                        ("pre_tokenizer", {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True})]:
        assert not any(packing.shortcuts({**description, part: value})[:3])
    assert packing.shortcuts({**description, "normalizer": lower})[:3] == (True, True, True)
    assert packing.shortcuts({**description, "normalizer": None})[:3] == (True, False, True)


def test_windows_far_apart_take_little_memory():
    import tracemalloc

    totals, at = np.full(64, 20_000_000), [0, 19_000_000]
    batch = pa.RecordBatch.from_arrays([
        pa.array([1, 2]), pa.array([7, 7], pa.int32()), pa.array(at), pa.array([0, 0]), pa.array([1000, 1000]),
        pa.array([np.arange(1000, dtype="<u2").tobytes()] * 2, pa.binary())],
        names=["doc_id", "queue", "place", "before", "n", "ids"])
    for weights in (np.ones(64), np.where(np.arange(64) == 7, 1e-4, 1.0)):  # the second: fewer than a token a window
        totals[7] = 20_000_000
        tracemalloc.start()
        (out,) = packing._pieces(totals, weights, 2048, "<u2")(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20
        rows = out.to_pylist()
        for doc in (1, 2):
            mine = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == doc)
            assert [s for s, _ in mine] == [0, *np.cumsum([n for _, n in mine])[:-1].tolist()] and sum(
                n for _, n in mine) == 1000
        windows = sorted(r["sequence_id"] for r in rows)
        assert windows[-1] - windows[0] > 500_000


def pack_rows():
    rng = np.random.default_rng(6)
    rows = [(k, "word " * int(rng.integers(0, 900)) + str(k), "big" if k % 3 else f"s{k % 5}") for k in range(120)]
    return rows + [(500, None, None), (501, "", None), (502, "x", "tiny"), (3, "again", "big"), (None, "no id", "big")]


def packed(spark, rows, **more):
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, queue int")
    return packing.pack(d.repartition(5), VOCABULARY, **more).collect()


@pytest.mark.parametrize("more", [{}, {"weights": {"tiny": 1.0, "s0": 3.0}}, {"max_queues": 2}, {"broadcast_rows": 0},
                                  {"width": 64}])
def test_packing(spark, more):
    rows, width = pack_rows(), more.get("width", 2048)
    ids = defaultdict(list)
    for (doc, text, _), encoded in zip(rows, direct([t for _, t, _ in rows])):
        ids[doc, len(encoded)].append(encoded)
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in packed(spark, rows, **more):
        assert p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        documents[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
    assert documents.keys() == ids.keys()
    for key, pieces in documents.items():
        (encoded,), at = ids[key], 0
        for start, length, crc in sorted(pieces):
            assert start == at
            assert crc == zlib.crc32(np.array(encoded[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(encoded)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, pieces in sequences.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == width or number == len(sequences) - 1 and at <= width


def test_packing_keeps_the_mixture(spark):
    rows = [(k, "word " * 700, "abc"[k % 3]) for k in range(90)]
    share = defaultdict(lambda: defaultdict(int))
    for p in packed(spark, rows, weights={"a": 2.0, "b": 1.0, "c": 1.0}):
        share[p.sequence_id][p.queue] += p.length
    full = [s for _, s in sorted(share.items())][:15]  # before a queue runs dry
    assert all(abs(s[0] - 1024) <= 1 and abs(s[1] - 512) <= 1 and abs(s[2] - 512) <= 1 for s in full)


@pytest.mark.parametrize("heavy", ["w", None])
def test_packing_keeps_weights_beyond_max_queues(spark, heavy):
    rows = [(k, "word " * 700, "big") for k in range(60)] + [(100 + k, "word " * 700, heavy) for k in range(30)]
    rows += [(200 + k, "word " * 60, f"tail{k}") for k in range(300)]
    of = {doc: source for doc, _, source in rows}
    share, queues = defaultdict(lambda: defaultdict(int)), defaultdict(set)
    for p in packed(spark, rows, max_queues=4, weights={heavy: 2.0, "big": 1.0}):
        source = of[p.doc_id]
        share[p.sequence_id][source if source in ("big", heavy) else "tail"] += p.length
        queues[p.queue].add(source)
    assert [q for q in queues.values() if q & {"big", heavy}] in ([{"big"}, {heavy}], [{heavy}, {"big"}])
    assert len(queues) <= 4
    tokens = {"big": 60 * 701, heavy: 30 * 701, "tail": 300 * 61}
    weight = {"big": 1.0, heavy: 2.0, "tail": tokens["tail"] * 3.0 / (tokens["big"] + tokens[heavy])}
    for number in range(5):  # before a queue runs dry
        for name, w in weight.items():
            assert abs(share[number][name] - 2048 * w / sum(weight.values())) <= 4, (number, name)


def test_packing_gives_large_sources_a_queue_of_their_own(spark):
    rows = [(k, "word " * 700, "abc"[k % 3]) for k in range(30)] + [(100 + k, "few", f"t{k}") for k in range(50)]
    queues = defaultdict(set)
    for p in packed(spark, rows, max_queues=4):
        queues[p.queue].add(p.doc_id % 3 if p.doc_id < 100 else "tail")
    assert sorted(map(str, queues.values())) == ["{'tail'}", "{0}", "{1}", "{2}"]


def test_packing_refuses_weights_it_cannot_keep(spark):
    d = spark.createDataFrame([(k, "x", f"s{k}") for k in range(5)], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        packing.pack(d, VOCABULARY, weights={"s0": 1.0, "s1": 1.0, "s2": 2.0}, max_queues=3)


def test_schedule_is_the_sorted_order_of_keys():
    rng = np.random.default_rng(8)
    for _ in range(20):
        totals = rng.integers(1, 60, int(rng.integers(1, 7)))
        weights = rng.choice([1.0, 2.0, 3.5, 7.0], len(totals))
        keys = sorted(((2 * i + 1) / w, q) for q, (n, w) in enumerate(zip(totals, weights)) for i in range(n))
        width = int(rng.integers(1, 9))
        schedule = packing.Schedule(totals, weights, width)
        for w, row in enumerate(schedule.cuts(np.arange(schedule.windows + 1))):
            counts = np.bincount([q for _, q in keys[:w * width]], minlength=len(totals))
            assert row.tolist() == counts.tolist()


def test_packing_empty(spark):
    d = spark.createDataFrame(pack_rows(), "doc_id long, text string, source string").limit(0)
    assert packing.pack(d, VOCABULARY).count() == 0


def page_rows():
    same = "<p>" + "same " * 400
    rows = [(k, f"http://h/{k} \r\nX: y", same) for k in range(40)]
    return rows + [(50, None, "short"), (51, "u", "short"), (52, "u", None), (53, "u", ""), (54, "u", "é\r\n\r\n" * 300),
                   (None, "u", same), (None, "v", "b" * 2000), (None, "w", "b" * 2000), (55, "u", "a" * 1000),
                   (56, "u", "a" * 1000), (57, "u", "a" * 999), (58, "u", "a" * 999), (56, "u", "a" * 1000)]


def test_archives(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    folder = warc.archive_folder(spark)
    index = warc.write_archives(warc.with_record_types(pages.repartition(3)), folder, file_bytes=2000)
    assert index.count() == len(rows) and index.select("file").distinct().count() > 3
    keep = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if i is not None and len(h) >= 1000:
            keep[h] = max(keep.get(h, i), i)
    expected = []
    for i, _, h in rows:
        h = (h or "").encode()
        to = keep.get(h)
        revisit = to is not None and to != i
        expected.append((i, "revisit" if revisit else "response", len(h), hashlib.sha1(h).hexdigest(),
                         to if revisit else None, None if revisit else h))
    for options in ({}, {"read_bytes": 300, "gap_bytes": 0}):
        got = [(r.record_id, r.record_type, r.header_bytes, r.header_digest, r.refers_to,
                None if r.payload is None else bytes(r.payload)) for r in warc.read_records(index, folder, **options).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
    few = warc.read_records(index.filter("record_id in (3, 54)"), folder).collect()
    assert sorted(r.record_id for r in few) == [3, 54]
    assert {r.url for r in few} == {"http://h/3%20%0D%0AX:%20y", "u"}


def test_record_is_a_gzip_member():
    row = {"page_id": 1, "url": "http://h/", "payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(),
           "payload_bytes": 3, "refers_to": None, "record_type": "response"}
    two = gzip.compress(warc.record_bytes(row)) * 2
    assert gzip.decompress(two) == warc.record_bytes(row) * 2
    with pytest.raises(ValueError):
        warc.parse_record(warc.record_bytes(row)[:-1])


def test_archives_empty(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").limit(0)
    folder = warc.archive_folder(spark)
    assert warc.read_records(warc.write_archives(warc.with_record_types(pages), folder), folder).count() == 0


@pytest.fixture(scope="module")
def net(spark):
    return language.fit(table(spark, SMALL, "documents").filter(crc32_of_id("doc_id") % 3 != 1))


def test_language_held_out(spark, net):
    documents = table(spark, SMALL, "documents")
    rows = language.identify(documents, net).join(documents.select("doc_id", "lang"), "doc_id").filter(
        crc32_of_id("doc_id") % 3 == 1).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - 1) < 0.01 for r in rows)


def test_language_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (7, 3))
    inputs = rng.standard_normal((24, 256)).astype(np.float64)
    states = rng.standard_normal((24, 8)).astype(np.float64)
    wanted = rng.standard_normal((7, 8, 3))

    def loss():
        return sum((s[0] * w).sum() for s, w in zip(language._forward(codes, inputs, states)[1:], wanted))

    d_inputs, d_states = language._backward(codes, language._forward(codes, inputs, states), states, wanted)
    for array, gradient, at in ((states, d_states, (3, 2)), (states, d_states, (20, 5)), (inputs, d_inputs, (9, codes[2, 1])),
                                (inputs, d_inputs, (17, codes[4, 0]))):
        array[at] += 1e-5
        up = loss()
        array[at] -= 2e-5
        down = loss()
        array[at] += 1e-5
        assert abs((up - down) / 2e-5 - gradient[at]) < 1e-2 * max(1, abs(gradient[at]))


def test_language_reading_equals_training_pass(net):
    """The fast pass over lanes of different lengths gives what the plain forward pass gives."""
    texts = [b"short", b"The quick brown fox jumps over the lazy dog and on", b"x"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got, _ = language.label(net, data, np.cumsum([0, *map(len, texts)]))
    for row, text in zip(got, texts):
        codes = np.frombuffer(text, np.uint8)[:, None].astype(int)
        states = [[s[0] for s in language._forward(c, net.inputs[k], net.states[k])[1:]]
                  for k, c in enumerate((codes, codes[::-1]))]
        logits = np.stack([net.out[0] @ a + net.out[1] @ b + net.bias for a, b in zip(states[0], states[1][::-1])])
        assert np.allclose(row, language._probabilities(logits, 1).mean(axis=(0, 2)), atol=1e-4)


@pytest.mark.parametrize("n", [4, 97, 130])
def test_language_turns(n):
    seen = np.bincount(np.concatenate([language._turns(k, n) for k in range(1, n + 1)]), minlength=n)
    assert seen.tolist() == [language.BATCH] * n


def test_every_language_of_many_is_trained(monkeypatch):
    """Texts of one byte each, so that short pieces are enough."""
    monkeypatch.setattr(language, "LENGTH", 4)
    names = [f"l{k:03d}" for k in range(120)]
    texts = [bytes([65 + k]) * 12 for k in range(120)]
    net = language.train(texts, names)
    pooled, shares = language.label(net, np.frombuffer(b"".join(texts), np.uint8), np.arange(121) * 12)
    right = [net.languages[b] == name for b, name in zip(pooled.argmax(axis=1), names)]
    assert np.mean(right) > 0.95 and np.mean(right[96:]) > 0.95 and np.allclose(pooled.sum(axis=1), 1)


def test_language_edges(spark, net):
    rows = [(1, None), (2, ""), (3, "12 345 !?"), (4, "die und das "), (4, "die und das "), (None, "the"), (5, "wort " * 40000)]
    d = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").coalesce(1)
    got = language.identify(d, net).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0, 0, 0]
    assert all(r.lang_pred != "und" for r in got[3:]) and got[3].score == got[4].score
    assert language.identify(d.limit(0), net).count() == 0
    assert {r.lang_pred for r in language.identify(d, None).collect()} == {"und"}
    assert language.fit(d.withColumn("lang", F.lit(None).cast("string"))) is None


@pytest.fixture(scope="module")
def toxic(spark):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    held = crc32_of_id("doc_id") % 5 == 0
    return toxicity.fit(documents.filter(~held), labels.filter(~held))


def test_toxicity_held_out(spark, toxic):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    rows = toxicity.score_documents(documents, toxic).join(labels, "doc_id").filter(
        crc32_of_id("doc_id") % 5 == 0).collect()
    truth, guess = np.array([r.toxic for r in rows]), np.array([r.score >= 0.5 for r in rows])
    assert truth.sum() > 3 and (guess == truth).mean() > 0.93 and guess[truth == 1].mean() > 0.7


def test_toxicity_edges(spark, toxic):
    rows = [(1, None), (2, ""), (3, "ab"), (4, "plain words " * 30000), (None, "you stupid pathetic worthless idiot, you scum"),
            (4, "plain words " * 30000)]
    d = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").coalesce(1)
    got = toxicity.score_documents(d, toxic).collect()
    assert got[0].score == got[1].score < 0.5 and got[2].score < 0.5 and got[3].score == got[5].score < 0.5
    assert toxicity.score_documents(d.limit(0), toxic).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert abs(toxicity.score(toxicity.fit(d, none), np.empty(0, np.uint8), np.array([0, 0]))[0] - 0.1) < 1e-6


def test_risk_is_kept_non_negative():
    """Where the unlabelled text is all positive, a plain corrected risk would run away; the classifier does not."""
    bad, good = b"you stupid idiot and scum, you moron " * 4, b"a quiet walk in the green park today " * 4
    model = toxicity.train([bad] * 40, [bad] * 20 + [good] * 180, 0.1, least_documents=1)
    data = np.frombuffer(bad + good, np.uint8)
    scores = toxicity.score(model, data, np.array([0, len(bad), len(bad) + len(good)]))
    assert scores[0] > 0.5 > scores[1]


def test_pipeline_keeps_text_where_no_language_can_be_learned(spark):
    rows = [(1, "clean text"), (2, "12 !?"), (3, None), (None, "é"), (4, "more text")]
    d = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, d, "")
    assert {r.doc_id for r in kept.collect()} == {1, None, 4}


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect() if any(map(str.isalpha, r.text or ""))]
    first = {}
    for doc, text in sorted(docs):
        first.setdefault(SPACES.sub(" ", text), doc)
    docs = [d for d in docs if first[SPACES.sub(" ", d[1])] == d[0]]
    alone = {d for d, _, _, kept in plain_near(docs) if kept}
    docs = [d for d in docs if d[0] in alone]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    clean = {d for d, _, _, _, bad in plain_hits(docs, items) if not bad}
    assert {r.doc_id for r in out} == clean
    tokens = dict(zip([d for d, _ in docs], map(len, direct([t for _, t in docs]))))
    assert sum(r.length for r in out) == sum(tokens[d] for d in clean)
