"""Exact and near dedup against plain versions."""

import hashlib
import re

import numpy as np
import pytest

from stayloom.llm import exact, near
from stayloom.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, kept string, keep_id int"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def docs(spark, rows):
    """Rows of (doc_id, text), with extra columns whose names clash with those of the results."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def plain_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACES.sub(" ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


def long_text(seed, n=9000):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n // 7))


ROWS = [(1, "a  b"), (2, "a\tb"), (3, "a b "), (4, None), (5, ""), (6, " "), (7, long_text(1)), (8, long_text(1)),
        (9, long_text(1) + "x"), (10, "x" + long_text(1)), (11, long_text(2, 60000)), (12, long_text(2, 60000)),
        (12, long_text(2, 60000)), (None, "a b"), (None, None), (13, "é" * 3000), (14, "é" * 3000), (15, "é" * 2999)]


@pytest.mark.parametrize("mask", [-1, 3, 0])  # with few bits, most chunks share their hash with others
def test_exact(spark, mask):
    got = exact.exact_duplicates(docs(spark, ROWS), mask=mask)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_exact(ROWS)


def test_exact_empty(spark):
    assert exact.exact_duplicates(docs(spark, ROWS).limit(0)).count() == 0


def test_cuts_follow_the_content():
    text = np.frombuffer(long_text(3, 40000).encode(), np.uint8)

    def pieces(data):
        ends = exact.chunk_bounds(data, 0, len(data), exact._offered_cuts(data))
        return {bytes(data[a:b]) for a, b in zip([0, *ends], ends)}

    moved = np.concatenate([np.frombuffer(b"something in front of it ", np.uint8), text])
    assert len(pieces(text) & pieces(moved)) >= 0.8 * len(pieces(text))
    assert b"".join(sorted(pieces(text))) != b"" and max(map(len, pieces(text))) <= exact.LONGEST


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def plain_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_near(rows):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None:
            names[r] = min(names.get(r, doc), doc)
    return sorted(((d, len(s), names.get(root(i)), d == names.get(root(i)))
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(rng, text, n):
    w = text.split(" ")
    for at in rng.choice(len(w), n, replace=False):
        w[at] = "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    return " ".join(w)


def near_rows():
    rng = np.random.default_rng(4)
    rows, base = [], long_text(5, 2100)  # 300 words
    rows += [(100 + k, edited(rng, base, int(rng.integers(1, 22)))) for k in range(90)]  # a group, many pairs below 0.75
    passage = long_text(6, 700)
    rows += [(300 + k, passage + " " + long_text(50 + k, int(rng.integers(350, 1400)))) for k in range(40)]
    chain = long_text(7, 1400)
    for k in range(12):  # each is near the one before
        rows.append((500 - k, chain))
        chain = edited(rng, chain, 4)
    rows += [(1, "one two"), (2, "ONE\ttwo"), (3, "one"), (4, None), (5, " \n"), (6, "a b c d e"), (7, "a b c d e f"),
             (8, "É b c d e"), (9, "é b c d e"), (None, "one two"), (None, "nobody has this text"), (10, base),
             (10, long_text(8, 900)), (11, long_text(8, 900))]
    return rows


def test_near(spark):
    rows = near_rows()
    got = near.near_duplicates(docs(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted(((r[0], r[1], r[2], r[3]) for r in got.collect()), key=repr)
    expected = [(d, n, c, (d is None and c is None) or k) for d, n, c, k in plain_near(rows)]
    assert found == sorted(expected, key=repr)


def test_near_empty(spark):
    assert near.near_duplicates(docs(spark, ROWS).limit(0)).count() == 0


def test_near_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "SHELF", 4)
    monkeypatch.setattr(near, "REQUESTS", 3)
    rows = near_rows()
    got = near.near_duplicates(docs(spark, rows), broadcast_rows=0)
    expected = [(d, n, c, (d is None and c is None) or k) for d, n, c, k in plain_near(rows)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(expected, key=repr)


def test_sets_equal_plain_ones():
    texts = [t or "" for _, t in near_rows()] + ["tail", "", "next  to it\x0b"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    known = {}
    for text, got in zip(texts, shingle_sets(data, offsets)):
        expected = plain_set(text)
        assert len(got) == len(expected)
        assert known.setdefault(frozenset(expected), got.tobytes()) == got.tobytes()
    assert len(set(known.values())) == len(known)
