"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Every text becomes its set of five-word shingles. Equal sets form a class; everything below works on classes.
2. A class has a signature of POSTED + EXTRA minima and is posted under each (coordinate, value) of the first POSTED.
   A pair that reaches THRESHOLD agrees in at least MATCHES of these, up to a chance of some 1e-6, so it shares one of
   the POSTED - MATCHES + 1 rarest postings of both (prefix). Postings that no other class has are skipped, and with
   them most of the corpus; frequent passages are at the end of that order and post nothing unless they are most of a
   text.
3. Under a posting, collisions of whole signatures are counted in blocks of BLOCK rows, and pairs with MATCHES and
   ALL_MATCHES agreements are retained; a pair is looked at under the first posting it shares only.
4. Retained pairs are confirmed on the full sets: 100 * intersection >= 75 * union. The shingles are 64-bit hashes.
   Classes lie in shelves of SHELF, ordered by component, and a class asks for all it is to be compared with on a shelf
   in one request, so that the texts of a group move once for many comparisons and not once for each.

Only the components are asked for, so pairs within a component need no look. The steps 3 and 4 run three times: each
class with one hub of its posting; then, between what is not yet connected, the PER_PAIR best pairs of two components;
then all that is left between different components. After the last pass every retained pair is confirmed, refuted, or
inside one component, so no link is lost, and a group of n copies costs n looks and not n * n.

Components are contracted with joins (hook to the smallest neighbour, jump to the roots, repeat) on written tables.

Defined results: a text without words (or null) has no shingles and is linked with nothing. A document of fewer than
five words has one shingle, all of them. Rows that repeat a ``doc_id`` are documents of their own under the same id. A
row without ``doc_id`` takes the component of its class; if its whole class has no id, it is linked with nothing. An
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import dense_key
from ..session import staged
from .common import text_batches, utf8
from .shingles import MinHash, set_digest, shingle_sets

#: 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
POSTED, EXTRA = 64, 128
#: 4.5 standard deviations below what a pair at the threshold agrees in on average.
MATCHES, ALL_MATCHES = 32, 117
PREFIX = POSTED - MATCHES + 1
#: Rows of a block, best pairs of two components, classes on a shelf, requests that one copy of a shelf answers.
BLOCK, PER_PAIR, SHELF, REQUESTS = 512, 4, 64, 256
#: Candidate classes up to which their ids are broadcast to fetch their texts; beyond that the join is a shuffle.
BROADCAST_ROWS = 1_000_000

_SIGNED = "doc_id long, n long, digest binary, posted array<int>, extra binary"
_PAIRS = "x long, y long"
_ASKED = "x long, shelf long, ys array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashing = MinHash(POSTED + EXTRA)
    for batch in batches:
        sizes, digests, posted, extra = [], [], [], []
        for shingles in shingle_sets(*utf8(batch.column("text"))):
            signature = hashing.signature(shingles)
            sizes.append(len(shingles))
            digests.append(set_digest(shingles))
            posted.append(signature[:POSTED])
            extra.append(signature[POSTED:].astype("<u2").tobytes())
        values = np.concatenate(posted).view(np.int32) if posted else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * POSTED, pa.int32()), pa.array(values)),
            pa.array(extra, pa.binary())], names=["doc_id", "n", "digest", "posted", "extra"])


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, as one table each. Only the last group of a batch is carried over."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _retained(group: dict, left: np.ndarray, right: np.ndarray, coordinate: int) -> tuple:
    """Rows of ``left`` and ``right`` whose signatures agree often enough, with the number of agreements."""
    posted, extra, sizes, parts, masks = (group[k] for k in ("posted", "extra", "n", "comp", "mask"))
    rows, columns, counts = [], [], []
    step = max(1, (8 << 20) // (max(len(right), 1) * (POSTED + EXTRA)))
    for at in range(0, len(left), step):
        mine = left[at:at + step]
        a, b = sizes[mine][:, None], sizes[right][None, :]
        possible = (100 * np.minimum(a, b) >= THRESHOLD * np.maximum(a, b)) & (
            parts[mine][:, None] != parts[right][None, :])
        i, j = np.nonzero(possible)
        i, j = mine[i], right[j]
        for s in range(0, len(i), 1 << 16):
            p, q = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
            same = posted[p] == posted[q]
            first = same.sum(axis=1)
            total = first + (extra[p] == extra[q]).sum(axis=1)
            keep = (first >= MATCHES) & (total >= ALL_MATCHES)
            # a pair is looked at under the first posting that both prefixes have
            keep &= (same & masks[p] & masks[q]).argmax(axis=1) == coordinate
            rows.append(p[keep])
            columns.append(q[keep])
            counts.append(total[keep])
    if not rows:
        return (np.empty(0, int),) * 3
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(counts)


def _looker(per_pair: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for table in _grouped(batches, ["token", "a", "b", "kind"]):
            m = table.num_rows
            group = {k: np.asarray(table.column(k).combine_chunks()) for k in ("cls", "n", "comp", "shelf", "side")}
            group["posted"] = np.asarray(table.column("posted").combine_chunks().flatten()).reshape(m, POSTED)
            group["extra"] = np.frombuffer(b"".join(table.column("extra").to_pylist()), "<u2").reshape(m, EXTRA)
            mask = np.asarray(table.column("mask").combine_chunks()).view(np.uint64)
            group["mask"] = (mask[:, None] >> np.arange(POSTED, dtype=np.uint64) & np.uint64(1)).astype(bool)
            coordinate = table.column("token")[0].as_py() >> 32
            if table.column("kind")[0].as_py() == 2:
                everyone = np.arange(m)
                p, q, n = _retained(group, everyone, everyone, coordinate)
                once = p < q
                p, q, n = p[once], q[once], n[once]
            else:
                p, q, n = _retained(group, np.flatnonzero(group["side"] == 0), np.flatnonzero(group["side"] == 1),
                                    coordinate)
            if per_pair is not None and len(p):  # the best of each pair of components
                low = np.minimum(group["comp"][p], group["comp"][q])
                high = np.maximum(group["comp"][p], group["comp"][q])
                order = np.lexsort((-n, high, low))
                new = np.ones(len(order), bool)
                new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
                begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                order = order[np.arange(len(order)) - begin < per_pair]
                p, q = p[order], q[order]
            if len(p):
                found.append(np.stack([group["cls"][q], group["shelf"][p], group["cls"][p]]))
                held += len(p)
            if held >= 1 << 20:
                yield _requests(found)
                found, held = [], 0
        if found:
            yield _requests(found)
    return run


def _requests(found: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each class and shelf, with what it is to be compared with there."""
    x, shelf, y = np.concatenate(found, axis=1)
    order = np.lexsort((y, shelf, x))
    x, shelf, y = x[order], shelf[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (shelf[1:] != shelf[:-1])
    at = np.flatnonzero(new)
    ys = pa.ListArray.from_arrays(pa.array(np.append(at, len(x)), pa.int32()), pa.array(y))
    return pa.RecordBatch.from_arrays([pa.array(x[at]), pa.array(shelf[at]), ys], names=["x", "shelf", "ys"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (shelf, part): first the classes of the shelf (``ys`` null), then what is asked of them."""
    at, sets = None, {}
    for batch in batches:
        links = []
        rows = zip(*(batch.column(k).to_pylist() for k in ("shelf", "part", "cls", "ys", "digest")))
        for (shelf, part, cls, ys, digest), shingles in zip(rows, shingle_sets(*utf8(batch.column("text")))):
            if (shelf, part) != at:
                at, sets = (shelf, part), {}
            if set_digest(shingles) != digest:  # another text under a repeated id
                continue
            if ys is None:
                sets[cls] = shingles
                continue
            for y in ys:
                other = sets[y]
                both = len(np.intersect1d(other, shingles, assume_unique=True))
                if 100 * both >= THRESHOLD * (len(other) + len(shingles) - both):
                    links.append((cls, y))
        x, y = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])


def _confirmed(asked: DataFrame, placed: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs asked for whose full sets are similar enough. A shelf that many ask for is copied for every REQUESTS
    of them."""
    parts = asked.groupBy(F.col("shelf").alias("_shelf")).agg(F.ceil(F.count("*") / REQUESTS).alias("parts"))
    dealt = asked.join(parts, F.col("shelf") == F.col("_shelf")).select(
        "shelf", F.pmod(F.xxhash64("x"), F.col("parts")).alias("part"), F.col("x").alias("cls"), "ys")
    copies = placed.join(parts, F.col("shelf") == F.col("_shelf")).select(
        "shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "cls",
        F.lit(None).cast("array<bigint>").alias("ys"))
    rows = dealt.unionByName(copies).join(texts, "cls").select("shelf", "part", "cls", "ys", "digest", "text")
    ordered = rows.repartition("shelf", "part").sortWithinPartitions("shelf", "part", F.col("ys").isNotNull())
    return staged(ordered.mapInArrow(_confirm, _PAIRS), "links")


def _placed(comps: DataFrame) -> DataFrame:
    """Components with the shelf of each class."""
    ordered = dense_key(comps.select("cls", "comp"), ["comp", "cls"], "place")
    return staged(ordered.select("cls", "comp", F.floor((F.col("place") - 1) / SHELF).cast("long").alias("shelf")),
                  "components")


def _connected(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (cls, comp) after adding links; a component is named by its smallest class."""
    x, y = (comps.select(F.col("cls").alias(f"_{k}"), F.col("comp").alias(k)) for k in ("u", "v"))
    edges = staged(links.join(x, F.col("x") == F.col("_u")).join(y, F.col("y") == F.col("_v")).filter(
        "u <> v").select("u", "v").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = staged(both.groupBy("u").agg(F.min("v").alias("v")).select(
            "u", F.least("u", "v").alias("parent")), "parents")
        while True:  # jump until every vertex points at a root
            above = parents.select(F.col("u").alias("_u"), F.col("parent").alias("above"))
            parents = staged(parents.join(above, F.col("parent") == F.col("_u")).select(
                "u", F.col("above").alias("parent"), (F.col("parent") != F.col("above")).alias("moved")), "parents")
            if parents.filter("moved").isEmpty():
                break
        ends = [parents.select(F.col("u").alias(f"_{k}"), F.col("parent").alias(f"p{k}")) for k in ("u", "v")]
        if roots is None:
            roots = parents.select("u", "parent")
        else:
            roots = staged(roots.join(ends[0], F.col("parent") == F.col("_u"), "left").select(
                "u", F.coalesce("pu", "parent").alias("parent")).unionByName(
                parents.select("u", "parent").join(roots.select("u"), "u", "left_anti")), "roots")
        edges = staged(edges.join(ends[0], F.col("u") == F.col("_u")).join(ends[1], F.col("v") == F.col("_v")).filter(
            "pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "edges")
    if roots is None:
        return comps.select("cls", "comp")
    return staged(comps.join(roots.select(F.col("u").alias("_u"), "parent"), F.col("comp") == F.col("_u"), "left")
                  .select("cls", F.coalesce("parent", "comp").alias("comp")), "components")


def _hub_rows(posts: DataFrame, cands: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks of the first pass: under each posting, a copy of its hub (the class of the smallest id) per block."""
    groups = posts.groupBy(F.col("token").alias("_token")).agg(
        F.count("*").alias("m"), F.min(F.struct("min_doc", "cls"))["cls"].alias("hub")).filter("m > 1")
    joined = posts.join(groups, F.col("token") == F.col("_token"))
    blocks = F.ceil(F.col("m") / BLOCK)
    own = F.array(F.pmod(F.xxhash64("cls"), blocks))
    at = F.when(F.col("cls") == F.col("hub"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(own)
    rows = joined.select("token", "cls", F.when(F.col("cls") == F.col("hub"), 0).otherwise(1).alias("side"),
                         F.explode(at).alias("a")).select(
        "token", "cls", "side", "a", F.lit(0).cast("long").alias("b"), F.lit(0).alias("kind"))
    return rows.join(cands.join(placed, "cls"), "cls")


def _cross_rows(posts: DataFrame, cands: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks of the later passes. Under each posting, the largest component is set against the rest, and the rest
    against itself; within the largest component nothing is left to look for."""
    labelled = posts.join(placed.select("cls", "comp"), "cls")
    sizes = labelled.groupBy("token", "comp").agg(F.count("*").alias("n_comp"))
    groups = sizes.groupBy(F.col("token").alias("_token")).agg(
        F.max(F.struct("n_comp", "comp")).alias("top"), F.sum("n_comp").alias("m"), F.count("*").alias("n")).filter(
        "n > 1")
    joined = labelled.join(groups, F.col("token") == F.col("_token"))
    main = F.col("comp") == F.col("top.comp")
    n_main, n_rest = F.ceil(F.col("top.n_comp") / BLOCK), F.ceil((F.col("m") - F.col("top.n_comp")) / BLOCK)
    spot = F.xxhash64("cls")

    def cell(kind, a, b, side):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), side.alias("side"))

    zero = F.lit(0).cast("long")
    in_main, in_rest = F.pmod(spot, n_main), F.pmod(spot, n_rest)
    of_main = F.transform(F.sequence(zero, n_rest - 1), lambda r: cell(0, r, in_main, F.lit(0)))
    of_rest = F.concat(
        F.transform(F.sequence(zero, n_main - 1), lambda g: cell(0, in_rest, g, F.lit(1))),
        F.transform(F.sequence(zero, n_rest - 1), lambda r: F.when(
            r == in_rest, cell(2, r, r, F.lit(0))).otherwise(cell(1, F.least(r, in_rest), F.greatest(r, in_rest),
                                                                F.when(in_rest < r, 0).otherwise(1)))))
    rows = joined.select("token", "cls", F.when(main, of_main).otherwise(of_rest).alias("cells"))
    return rows.select("token", "cls", F.inline_outer("cells")).join(cands.join(placed, "cls"), "cls")


def _look(rows: DataFrame, per_pair: int | None) -> DataFrame:
    ordered = rows.select(
        "token", "a", "b", "kind", "side", "cls", "n", "comp", "shelf", "mask", "posted", "extra").repartition(
        "token", "a", "b", "kind").sortWithinPartitions("token", "a", "b", "kind")
    return staged(ordered.mapInArrow(_looker(per_pair), _ASKED).groupBy("x", "shelf").agg(
        F.flatten(F.collect_list("ys")).alias("ys")), "requests")  # SHELF entries at most


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    signed = staged(rows.mapInArrow(_sign, _SIGNED), "signatures")
    classes = staged(signed.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("min_doc"), F.first("n").alias("n"), F.first("posted").alias("posted"),
        F.first("extra").alias("extra")).filter("min_doc is not null").withColumn(
        "cls", F.monotonically_increasing_id()), "classes")

    tokens = classes.select("cls", F.posexplode("posted").alias("k", "v")).select("cls", (
        F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(
            F.lit(0xFFFFFFFF).cast("long"))).alias("token"))
    common = tokens.groupBy(F.col("token").alias("_token")).agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(common, F.col("token") == F.col("_token")).groupBy("cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t")).filter(F.size("t") >= MATCHES)
    # what is not shared fills the prefix first
    prefix = shared.select(F.col("cls").alias("_cls"), F.transform(F.slice(
        "t", F.lit(1), F.greatest(F.lit(0), F.lit(PREFIX - POSTED) + F.size("t"))), lambda x: x["token"]).alias("prefix"))
    mask = F.aggregate("prefix", F.lit(0).cast("long"), lambda m, t: m.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t, 32).cast("int"))))
    cands = staged(classes.join(prefix, F.col("cls") == F.col("_cls")).withColumn("mask", mask).drop("_cls"),
                   "candidates")
    posts = staged(cands.select("cls", "min_doc", F.explode("prefix").alias("token")), "posts")
    wanted = cands.select(F.col("min_doc").alias("_doc"), "cls", "digest")
    wanted = F.broadcast(wanted) if cands.count() <= broadcast_rows else wanted
    texts = staged(rows.join(wanted, F.col("doc_id") == F.col("_doc")).select("cls", "digest", "text"), "texts")
    signs = cands.select("cls", "n", "mask", "posted", "extra")

    placed = _placed(cands.select("cls", F.col("cls").alias("comp")))
    asked = _look(_hub_rows(posts, signs, placed), None)
    comps = _connected(placed, _confirmed(asked, placed, texts))
    for per_pair in (PER_PAIR, None):
        placed = _placed(comps)
        asked = _look(_cross_rows(posts, signs, placed), per_pair)
        comps = _connected(placed, _confirmed(asked, placed, texts))

    labels = cands.select("cls", "min_doc").join(comps, "cls")
    names = labels.groupBy("comp").agg(F.min("min_doc").alias("component")).withColumnRenamed("comp", "_comp")
    linked = labels.join(names, F.col("comp") == F.col("_comp")).select(F.col("cls").alias("_cls"), "component")
    of_class = staged(classes.select("cls", F.col("digest").alias("_digest"), "min_doc").join(
        linked, F.col("cls") == F.col("_cls"), "left").select(
        "_digest", F.coalesce("component", "min_doc").alias("component")), "class-components")
    every = signed.select("doc_id", "n", "digest", (F.col("n") > 0).alias("full"))
    component = F.coalesce("component", "doc_id")
    return every.join(of_class, (F.col("digest") == F.col("_digest")) & F.col("full"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))
