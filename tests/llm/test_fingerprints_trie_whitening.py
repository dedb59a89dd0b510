"""Golay-code fingerprints, the prefix trie and whitening against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

from stayloom.llm import golay, trie, whitening
from stayloom.llm.scan import prefix_scan

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- fingerprints ----------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    link, label = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, np.arange(len(rows))
    while True:
        new = np.where(link, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            break
        label = new
    ids = {at: [i for (i, _), k in zip(rows, label) if k == at and i is not None] for at in set(label.tolist())}
    return sorted([(i, f"{int(p):016x}", min(ids[k], default=None)) for (i, _), p, k in zip(rows, prints, label)],
                  key=repr)


def varied(n, words=400, seed=5):
    """Copies of one text, each with a word changed: many fingerprints a bit or two apart."""
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(0, 5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        text[rng.integers(0, words)] = f"x{i}"
        out.append(" ".join(text))
    return out


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A b"), (6, "a\tB"), (6, "a B"), (None, "a b"), (None, "lonely one here"),
         (7, "É é   x"), (8, "é é   x"), (9, "word " * 200_000), (10, "WORD\n" * 200_000), (11, "a b c d e f")]


@pytest.mark.parametrize("bucket", [512, 3, 1])  # with small buckets, most keys go through the words between
def test_fingerprints(spark, bucket):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(varied(60))]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows],
                               "doc_id long, text string, fingerprint string, key int, print int").repartition(3)
    got = golay.near_fingerprints(df, bucket=bucket)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = plain_components(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert len({w[2] for w in want}) < len({w[1] for w in want})  # some different fingerprints do link
    listed = golay.near_fingerprints(df, bucket=1, broadcast_rows=0) if bucket == 1 else got
    assert sorted(map(tuple, listed.collect()), key=repr) == want


def test_no_documents(spark):
    assert golay.near_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_golay_keys():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 500)
    keys = [set(k) for k in golay.nearby_codewords(words).tolist()]
    assert max(map(len, keys)) == 6
    for word, own in zip(words.tolist(), keys):
        for _ in range(5):
            a, b = rng.integers(0, 23, 2).tolist()
            assert own & set(golay.nearby_codewords(np.array([word ^ 1 << a ^ 1 << b]))[0].tolist())


def test_two_bits_share_a_key():
    rng = np.random.default_rng(4)
    for _ in range(300):
        p = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        q = p ^ 1 << int(rng.integers(0, 64)) ^ 1 << int(rng.integers(0, 64))
        keys = [{k for ks, _ in golay.segment_keys(np.array([x], np.uint64)) for k in ks.tolist()} for x in (p, q)]
        assert keys[0] & keys[1] and len(keys[0]) <= 18


def test_long_text_in_pieces(monkeypatch):
    text = varied(1, 3000)[0] + " É  end"
    whole = golay.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(golay, "_BYTES", size)
        assert golay.fingerprint(text.encode()) == whole


# --- scans -----------------------------------------------------------------------------------------------------------

def test_scan_of_a_group_over_many_partitions(spark):
    rows = [(0, i, i * i) for i in range(500)] + [(1, 0, 7)] + [(2, i, -i) for i in range(50)]
    df = spark.createDataFrame(rows, "g long, i long, v long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.i): (r.s, r.x) for r in prefix_scan(df, ["g", "i"], {"s": "v"}, {"x": "v"}, "g").collect()}
        total = {r.i: r.s for r in prefix_scan(df.filter("g = 0"), ["i"], {"s": "v"}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    held = {}
    for g, i, v in rows:
        s, x = held.get(g, (0, 0))
        held[g] = s + v, x ^ v
        assert got[g, i] == held[g]
        assert g or total[i] == held[g][0]
    assert prefix_scan(df.limit(0), ["g", "i"], {"s": "v"}, group="g").count() == 0


# --- trie ------------------------------------------------------------------------------------------------------------

def plain_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            turns.setdefault(conv, []).append(
                ((turn is not None, turn or 0), role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + own[c][h:]
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        ends = ",".join(str(c) for c in sorted(members) if tuple(built[c]) == path)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in below),
                    sum(not any(q[:-1] == p for q in below if q) for p in below),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed=1, n=40):
    rng = np.random.default_rng(seed)
    rows = []
    for c in [*rng.choice(260, n, replace=False).tolist(), -7, -200]:
        for turn in range(rng.integers(1, 9)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"say {rng.integers(0, 3)}"))
    return rows


TALKS = talks() + [(0, None, "system", "be kind"), (0, 3, None, None), (0, 3, None, None), (0, 3, "user", "x" * 50_000),
                   (None, 0, "user", "of nobody"), (501, 0, "user", "")] + [(700, i, "user", str(i % 7)) for i in range(900)] + [
                       (701 + k, i, "user", str(i % 7)) for k in range(3) for i in range(900)]


@pytest.mark.parametrize("arcs", [1_000_000, 50])
def test_trie(spark, arcs):
    rows = [(*r, 1, "x") for r in (TALKS if arcs > 50 else talks(2))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, place string")
    got = trie.prefix_trie(df.repartition(3), arcs_per_partition=arcs)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    small = [r[:4] for r in rows if r[0] is None or r[0] < 700]
    if arcs > 50:  # the four long ones are one path, too deep for the plain version's sums
        assert {(r.conv_id, r.depth) for r in got.collect()} > {(r[0], r[1]) for r in plain_trie(small)}
        got = trie.prefix_trie(spark.createDataFrame(
            small, "conv_id long, turn long, role string, text string").repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(small)


def test_trie_of_one_long_path(spark):
    rows = [(700 + k, i, "user", str(i)) for k in range(3) for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.depth): r for r in trie.prefix_trie(df, arcs_per_partition=100).collect()}
    assert len(got) == 901 and all(c == 700 for c, _ in got)
    chars = [len(str(i)) for i in range(900)]
    for (_, d), r in got.items():
        assert (r.n_convs, r.n_children, r.n_leaves) == (3, int(d < 900), 1)
        assert r.saved_tokens == 2 * sum(chars[max(d - 1, 0):])
    assert got[700, 900].ends_sha256 == hashlib.sha256(b"700,701,702").hexdigest()


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(empty).count() == 0
    nobody = spark.createDataFrame([(None, 0, "user", "x")], empty.schema)
    assert trie.prefix_trie(nobody).count() == 0


def test_pieces_of_a_digest(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    ends = spark.createDataFrame([(i, 1, 5, 6) for i in range(300)] + [(-4, 0, 0, 0)], "conv_id long, depth long, a long, b long")
    got = {r.depth: r.sha for r in trie.end_digests(ends.repartition(4)).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest(),
                   0: hashlib.sha256(b"-4").hexdigest()}


# --- whitening -------------------------------------------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))

    def of(values):
        v = q @ np.diag(values) @ q.T
        return (v + v.T) / 2

    x = rng.standard_normal((10, 40))
    return {"plain": of(rng.uniform(1, 9, 40)), "repeated": of([5.0] * 7 + [3.0] * 20 + [1.0] * 13),
            "identity": np.eye(40), "few": np.cov(x.T, bias=True), "close": of(1 + np.arange(40) * 1e-9),
            "steep": of(10.0 ** -np.arange(40)), "zero": np.zeros((40, 40)), "one": np.diag([2.0] + [0.0] * 39)}


@pytest.mark.parametrize("name", sorted(matrices()))
def test_components(name):
    v = matrices()[name]
    values, vectors = whitening.leading_components(v)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:32]
    assert len(values) == min(32, int((want > 1e-11 * np.abs(v).sum(axis=1).max()).sum()))
    if len(values):
        size = want[0]
        assert np.abs(values - want[:len(values)]).max() < 1e-14 * 40 * size
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
        assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-13 * 40 * size


def test_inertia():
    rng = np.random.default_rng(8)
    for d in (1, 2, 3, 17, 40):
        for _ in range(20):
            a = rng.standard_normal((d, d))
            a = a + a.T
            np.fill_diagonal(a, np.diag(a) * rng.integers(0, 2))  # zeros on the diagonal need pivots of two rows
            assert whitening.negative_pivots(a) == (np.linalg.eigvalsh(a) < 0).sum()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, n int, whitened string").repartition(3)


BAD = [(900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []),
       (905, [1.0] * 4), (906, [3e38] + [0.0] * 5)]


@pytest.mark.parametrize("size", [1.0, 1e9])  # large entries leave the exact products
def test_whitening(spark, size):
    rng = np.random.default_rng(9)
    mixed = (rng.standard_normal((80, 6)) @ rng.standard_normal((6, 6)) * size).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(3, mixed[3].tolist()), (None, mixed[5].tolist())]
    got = whitening.whitened_components(vectors(spark, rows + BAD)).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = np.floor(64 * np.array([v for _, v in rows]).astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, c = len(x), x - x.mean(axis=0)
    assert len(got) == n * 6 and (got.n == n).all() and got.identity_error.max() < 1e-9
    values, q = np.linalg.eigh(c.T @ c / n)
    want = (c @ q / np.sqrt(values))[:, ::-1]
    one = got[got.vec_id == 17].sort_values("component")
    assert np.allclose(np.abs(one.whitened), np.abs(want[17]), rtol=1e-7, atol=1e-9)
    assert np.allclose(one.explained, values[::-1] / values.sum(), rtol=1e-10)
    exact = ((n * x.astype(object) - x.astype(object).sum(axis=0)) ** 2).sum(axis=1)
    for i, r in got[got.component == 1].set_index("vec_id").deviation.items():
        if i == i and i != 3:
            assert (r == exact[int(i)]) if exact[int(i)] < 1 << 63 else r != r or r is None
    for k in range(1, 7):  # either sign, the same for all rows
        w = got[(got.component == k) & got.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id").whitened
        signs = np.sign([w[i] * want[i, k - 1] for i in range(80)])
        assert abs(signs.sum()) == 80


@pytest.mark.parametrize("rows", [[], BAD, [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whitened_components(vectors(spark, rows)).count() == 0
