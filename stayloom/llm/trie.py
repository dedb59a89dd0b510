"""Trie of conversation prefixes, measured by the Euler-tour technique.

1. Every conversation is rebuilt: it opens with turns of the conversation that it was forked from. Each distinct
   sequence of first turns is a node; sequences are told apart by 128 bits of position-wise hashes, combined in a prefix
   scan. A node is named by its smallest member and its depth.
2. A node has two arcs, one that enters it and one that leaves it. Each arc knows the next one of a walk around the tree:
   into the first child, over to the next sibling, back up to the parent. Siblings are neighbours in one global order,
   so a parent of any number of children is never one group.
3. The walk is ranked as a list: arcs that lie in one partition are contracted to runs first (a conversation and its
   neighbours mostly do), and runs are ranked by pointer jumping, in a number of rounds that is the logarithm of theirs.
4. Arcs in the order of the walk carry what a node adds (a leaf, saved tokens). Prefix sums at the entering and the
   leaving arc differ by the sum over the subtree.

Defined results: rows without ``conv_id`` belong to no conversation, and are left out. Null roles and texts are empty;
turns of equal number are ordered by role and by the MD5 of their text, rows that repeat a turn are turns of their own. An
empty table has no nodes, not even a root. Other columns of the input are ignored.

A digest over the ids that end at a node is one stream by its nature; the ids are sorted and written out by many tasks,
and one task only hashes the pieces of a node, a piece at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import dense_key
from ..session import staged
from .scan import prefix_scan

#: A conversation is forked from the one at the start of its block of ids, at a turn below MOST.
FORKED, MOST = 100, 6
#: Arcs of a partition in which runs are contracted.
ARCS = 1_000_000
#: Ids written out in one piece.
PIECE = 10_000
_EMPTY = hashlib.sha256(b"").hexdigest()
_CONTRACTED = "arc long, head long, offset long, leaf long, saved long, next long, tail boolean"


# --- rebuilt conversations -------------------------------------------------------------------------------------------

def rebuilt_turns(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
                  role_column: str = "role", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, depth, role, digest, chars`` of the rebuilt conversations, and all their ids."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = conversations.select(
        F.col(id_column).cast("long").alias("conv_id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one")).filter("conv_id is not null")
    numbered = prefix_scan(own, ["conv_id", "turn", "role", "digest"], {"place": "one"}, group="conv_id",
                           label="turns").drop("one", "turn")
    conv = F.col("conv_id")
    height = (F.crc32(conv.cast("string").cast("binary")) % MOST).alias("h")
    ids = staged(numbered.filter("place = 1").select("conv_id", height, (conv - conv % FORKED).alias("base")),
                 "conversations")
    heads = numbered.filter((conv % FORKED == 0) & (F.col("place") < MOST)).withColumnRenamed("conv_id", "_base")
    opened = staged(ids.join(heads, (F.col("base") == F.col("_base")) & (F.col("place") <= F.col("h"))).select(
        "conv_id", F.col("place").alias("depth"), "role", "digest", "chars"), "openings")
    taken = opened.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("taken"))
    rest = numbered.filter(F.col("place") > height).join(taken, conv == F.col("_conv"), "left").select(
        "conv_id", (F.col("place") - height + F.coalesce("taken", F.lit(0))).alias("depth"), "role", "digest", "chars")
    return opened.unionByName(rest), ids.select("conv_id")


def prefix_nodes(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Nodes ``conv, depth, parent, n_convs, chars, a, b`` (a, b: their 128 bits), and where each conversation ends."""
    first = ids.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    if not first["n"]:
        return None
    hashed = turns.select("conv_id", "depth", "chars", F.xxhash64("depth", "role", "digest").alias("x"),
                          F.xxhash64("digest", "role", "depth").alias("y"))
    rows = prefix_scan(hashed, ["conv_id", "depth"], {}, {"a": "x", "b": "y"}, "conv_id", "prefixes")
    nodes = staged(rows.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
        F.first(F.col("a").bitwiseXOR(F.col("x"))).alias("pa"), F.first(F.col("b").bitwiseXOR(F.col("y"))).alias("pb")),
        "nodes")
    above = nodes.select((F.col("depth") + 1).alias("_d"), F.col("a").alias("_a"), F.col("b").alias("_b"),
                         F.col("conv").alias("_parent"))
    deeper = nodes.filter("depth > 1").join(
        above, (F.col("depth") == F.col("_d")) & (F.col("pa") == F.col("_a")) & (F.col("pb") == F.col("_b")))
    columns = ["conv", "depth", "parent", "n_convs", "chars", "a", "b"]
    zero = F.lit(0).cast("long")
    root = ids.sparkSession.range(1).select(
        F.lit(first["least"]).cast("long").alias("conv"), zero.alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(first["n"]).cast("long").alias("n_convs"), zero.alias("chars"), zero.alias("a"), zero.alias("b"))
    whole = root.unionByName(
        nodes.filter("depth = 1").withColumn("parent", F.lit(first["least"]).cast("long")).select(*columns)).unionByName(
        deeper.withColumn("parent", F.col("_parent")).select(*columns))
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("end"))
    turnless = ids.join(last.select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"))
    return whole, last.select("conv_id", "end.*").unionByName(turnless)


# --- the walk --------------------------------------------------------------------------------------------------------

def walk_arcs(placed: DataFrame, family: DataFrame) -> DataFrame:
    """Arcs ``arc`` (twice the node's place, and one more to leave it), ``next``, ``conv, depth, leaf, saved``."""
    enter, leave, zero = 2 * F.col("place"), 2 * F.col("place") + 1, F.lit(0).cast("long")
    parents = staged(placed.join(family, (F.col("conv") == F.col("_conv")) & (F.col("depth") == F.col("_depth")), "left")
                     .withColumn("n_children", F.coalesce("n_children", zero)), "families")
    entering = parents.select(
        enter.alias("arc"), F.coalesce(2 * F.col("first"), leave).alias("next"), "conv", "depth",
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    returning = parents.filter("n_children > 0").select(
        (2 * F.col("last") + 1).alias("arc"), leave.alias("next"), F.col("last_conv").alias("conv"),
        (F.col("depth") + 1).alias("depth"), zero.alias("leaf"), zero.alias("saved"))
    lasts = family.select(F.col("last").alias("_last"))
    over = placed.filter("depth > 0").join(lasts, F.col("place") == F.col("_last"), "left_anti").select(
        leave.alias("arc"), (2 * (F.col("place") + 1)).alias("next"), "conv", "depth", zero.alias("leaf"),
        zero.alias("saved"))
    end = placed.filter("depth = 0").select(leave.alias("arc"), F.lit(None).cast("long").alias("next"), "conv", "depth",
                                            zero.alias("leaf"), zero.alias("saved"))
    return staged(entering.unionByName(returning).unionByName(over).unionByName(end), "arcs"), parents


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of arcs that follow each other within the partition: the first arc of each, and how far after it one is."""
    table = pa.Table.from_batches(list(batches))  # a partition of some ARCS arcs
    if not table.num_rows:
        return
    arc = np.asarray(table.column("arc").combine_chunks())
    order = np.argsort(arc)
    arc, table = arc[order], table.take(pa.array(order))
    following = table.column("next").combine_chunks()
    at = np.asarray(following.fill_null(-1))
    spot = np.minimum(np.searchsorted(arc, at), len(arc) - 1)
    here = arc[spot] == at
    before = np.arange(len(arc))
    before[spot[here]] = np.flatnonzero(here)
    offset = (before != np.arange(len(arc))).astype(np.int64)
    while True:
        further = before[before]
        if (further == before).all():
            break
        offset = offset + offset[before]
        before = further
    columns = {"arc": pa.array(arc), "head": pa.array(arc[before]), "offset": pa.array(offset),
               "leaf": table.column("leaf").combine_chunks(), "saved": table.column("saved").combine_chunks(),
               "next": following, "tail": pa.array(~here)}
    yield from pa.table(columns).to_batches(max_chunksize=1 << 16)


def ranked(arcs: DataFrame, arcs_per_partition: int = ARCS) -> DataFrame:
    """``arc, position, leaf, saved``: position counts from 0 at the head of the list."""
    spark, n = arcs.sparkSession, arcs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // arcs_per_partition))
    runs = staged(arcs.repartitionByRange(parts, "conv", "depth").mapInArrow(_contract, _CONTRACTED), "runs")
    ranks = staged(runs.filter("tail").select("head", "next", (F.col("offset") + 1).alias("left")), "ranks")
    while not ranks.filter("next is not null").isEmpty():
        beyond = ranks.select(F.col("head").alias("_head"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        ranks = staged(ranks.join(beyond, F.col("next") == F.col("_head"), "left").select(
            "head", F.col("_next").alias("next"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left")), "ranks")
    left = ranks.select(F.col("head").alias("_head"), "left")
    return runs.join(left, F.col("head") == F.col("_head")).select(
        "arc", (F.lit(n) - F.col("left") + F.col("offset")).alias("position"), "leaf", "saved")


# --- digests of the ids that end at a node ---------------------------------------------------------------------------

def _rows(rows: Iterator[tuple], columns: str, at_once: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of tuples; the last column is text, the others are whole numbers."""
    names = columns.split()
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield batch()
            held = []
    if held:
        yield batch()


def _write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition as pieces of comma-joined ids, each of one node."""
    def pieces() -> Iterator[tuple]:
        node, ids = None, []
        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_numpy().tolist() for c in ("depth", "a", "b", "conv_id"))):
                if ids and (node != key or len(ids) >= PIECE):
                    yield *node, ids[0], ",".join(map(str, ids))
                    ids = []
                node = key
                ids.append(conv)
        if ids:
            yield *node, ids[0], ",".join(map(str, ids))

    yield from _rows(pieces(), "depth a b least piece", 16)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, hashed node by node."""
    def digests() -> Iterator[tuple]:
        node, sha = None, None
        for batch in batches:
            columns = [batch.column(c).to_numpy().tolist() for c in ("depth", "a", "b")]
            for *key, text in zip(*columns, batch.column("piece").to_pylist()):
                if node == key:
                    sha.update(b"," + text.encode())
                    continue
                if node is not None:
                    yield *node, sha.hexdigest()
                node, sha = key, hashlib.sha256(text.encode())
        if node is not None:
            yield *node, sha.hexdigest()

    yield from _rows(digests(), "depth a b sha")


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, a, b, sha``: SHA-256 of the ids of the conversations that end at a node."""
    key = ["depth", "a", "b"]
    pieces = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(
        _write_out, "depth long, a long, b long, least long, piece string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "least").mapInArrow(
        _digest, "depth long, a long, b long, sha string")


def prefix_trie(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
                role_column: str = "role", text_column: str = "text", arcs_per_partition: int = ARCS) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    made = prefix_nodes(*rebuilt_turns(conversations, id_column, turn_column, role_column, text_column))
    if made is None:
        return conversations.sparkSession.createDataFrame([], (
            "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, ends_sha256 string"))
    nodes, ends = made
    placed = staged(dense_key(nodes, ["depth", "parent", "conv"], "place"), "places")
    family = staged(placed.filter("depth > 0").groupBy(
        F.col("parent").alias("_conv"), (F.col("depth") - 1).alias("_depth")).agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.max("conv").alias("last_conv"),
        F.count("*").alias("n_children")), "siblings")
    arcs, parents = walk_arcs(placed, family)
    summed = prefix_scan(ranked(arcs, arcs_per_partition), ["position"], {"leaves": "leaf", "savings": "saved"},
                         label="walk")
    spans = summed.groupBy((F.col("arc") / 2).cast("long").alias("_place")).agg(
        (F.max("leaves") - F.min("leaves") + F.sum("leaf")).alias("n_leaves"),
        (F.max("savings") - F.min("savings") + F.sum("saved")).alias("saved_tokens"))
    digests = end_digests(ends).select(F.col("depth").alias("_d"), F.col("a").alias("_a"), F.col("b").alias("_b"), "sha")
    return parents.join(spans, F.col("place") == F.col("_place")).join(
        digests, (F.col("depth") == F.col("_d")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")),
        "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"))
