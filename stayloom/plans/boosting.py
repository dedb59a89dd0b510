"""Boosted trees as Spark ML grows them, by tasks that keep their rows from the first round to the last.

Spark ML runs a job for every level of every tree, and 300 rounds of depth 6 are 1,800 jobs that follow one another. Here
one barrier stage holds the rows, binned, and its tasks meet once a level: each writes the sums of its rows per node and
bin to the shared folder, the first task adds them up, chooses the splits and writes them for the others. What meets there
has the size of a tree level, whatever the number of rows. Split candidates, gains, residuals and the stored model are
those of Spark ML; sums are added in another order.
"""

from __future__ import annotations

import json
import math
import os
import pickle
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder

#: Rows for a task at least, so that small tables do not wait for many tasks, and at most: some 150 bytes of memory a row.
#: Larger tables are left to Spark ML, which can spill.
LEAST_ROWS, MOST_ROWS = 20_000, 2_000_000
#: Seconds in which all tasks must have met in the shared folder; otherwise it is not shared, and Spark ML fits.
MEET_S = 60
CHUNK = 1 << 15
SAMPLE_ROWS = 10_000  # as in Spark ML: rows (some) that the split candidates come from, maxBins² where that is more
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
         "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


class Boosting(GBTClassifier):
    """``GBTClassifier`` with this way of fitting where it applies; else Spark ML's own."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        fitted = _fitted(self, dataset)
        return super()._fit(dataset) if fitted is None else fitted


def _local_folder(spark) -> str | None:
    """The shared folder as a path of the file system, if it lies there."""
    folder = f"{shared_folder(spark)}/scratch/boosting-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return path.toUri().getPath() if store.getUri().getScheme() == "file" else None


def _binary_features(dataset: DataFrame, column: str) -> list[int] | None:
    """Features with two categories; None if there are some with more."""
    kinds = dataset.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    sizes = {a["idx"]: a.get("num_vals", len(a.get("vals", ()))) for a in kinds.get("nominal", ())}
    return None if any(n != 2 for n in sizes.values()) else sorted({a["idx"] for a in kinds.get("binary", ())} | set(sizes))


def _fitted(self: Boosting, dataset: DataFrame) -> GBTClassificationModel | None:
    spark, sc = dataset.sparkSession, dataset.sparkSession.sparkContext
    label, weight, vector = self.getLabelCol(), self.isSet("weightCol") and self.getWeightCol(), self.getFeaturesCol()
    binary, folder = _binary_features(dataset, vector), _local_folder(spark)
    usual = (self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() == "all" and not self.getLeafCol()
             and not self.isDefined("validationIndicatorCol") and not self.isDefined("thresholds")
             and self.getMinWeightFractionPerNode() == 0.0 and self.getImpurity() == "variance")
    if not usual or binary is None or folder is None or sc.getConf().get("spark.dynamicAllocation.enabled") == "true":
        return None
    rows = dataset.select(vector, F.col(label).cast("double").alias("_y"),
                          (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w"))
    n, total = rows.agg(F.count("*"), F.sum("_w")).first()
    slots = sc._jsc.sc().maxNumConcurrentTasks(sc._jsc.sc().resourceProfileManager().defaultResourceProfile())
    tasks = max(1, min(slots, math.ceil(n / LEAST_ROWS)))
    if n < 2 or n > tasks * MOST_ROWS:
        return None
    layout = Layout(*_thresholds(rows, vector, binary, n, total, self.getMaxBins(), self.getSeed()))
    sizes = dict(rounds=self.getMaxIter(), depth=self.getMaxDepth(), rate=self.getStepSize(),
                 least=self.getMinInstancesPerNode(), least_gain=self.getMinInfoGain())
    os.makedirs(folder, exist_ok=True)
    stored = f"file://{folder}/model"
    held = rows.repartition(tasks).select(vector_to_array(vector).alias("x"), "_y", "_w")
    grown = held.mapInArrow(lambda batches: _grow(batches, layout, folder, tasks, **sizes), NODES, barrier=True)
    grown.repartition(1).write.parquet(f"{stored}/data")  # Spark does not repeat a barrier stage that writes
    if spark.read.schema(NODES).parquet(f"{stored}/data").isEmpty():
        return None
    return _loaded(self, dataset, stored)


def _loaded(self: Boosting, dataset: DataFrame, stored: str) -> GBTClassificationModel:
    """The model with the nodes at ``stored``. The other files of a stored model are those of one that Spark ML fits in a
    round over a few rows, with as many trees as there are."""
    spark, rounds = dataset.sparkSession, self.getMaxIter()
    pattern = GBTClassifier._fit(self.copy({self.maxIter: 1}), dataset.limit(20))
    pattern.write().save(f"{stored}-pattern")
    about = json.loads(spark.read.text(f"{stored}-pattern/metadata").first()["value"])
    about["paramMap"]["maxIter"], about["numTrees"] = rounds, rounds
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{stored}/metadata")
    tree = spark.read.parquet(f"{stored}-pattern/treesMetadata").first()["_2"]
    spark.range(rounds).select(
        F.col("id").cast("int").alias("_1"), F.lit(tree).alias("_2"),
        F.when(F.col("id") == 0, 1.0).otherwise(self.getStepSize()).alias("_3")).coalesce(1).write.parquet(
        f"{stored}/treesMetadata")
    return self._copyValues(GBTClassificationModel.load(stored))


# --- split candidates --------------------------------------------------------------------------------------------


def _thresholds(rows: DataFrame, vector: str, binary: list[int], n: int, total: float, max_bins: int, seed: int):
    """Thresholds of each feature that is no binary one, from the rows that Spark ML would look at; and the binary ones."""
    spark, jvm = rows.sparkSession, rows.sparkSession.sparkContext._jvm
    bins = min(max_bins, n)
    wanted = max(bins * bins, SAMPLE_ROWS)
    share = wanted / n if wanted < n else 1.0
    if share < 1.0:
        draw = jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = rows._jdf.toJavaRDD().sample(False, share, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    table = rows.select(vector_to_array(vector).alias("x"), "_w").toArrow()  # some 10,000 rows
    weights = table["_w"].to_numpy()
    values = table["x"].combine_chunks().flatten().to_numpy().reshape(len(weights), -1)
    numeric = {f: split_thresholds(values[:, f], weights, share * total, bins - 1)
               for f in range(values.shape[1]) if f not in set(binary)}
    return values.shape[1], {f: t for f, t in numeric.items() if len(t)}, binary


def split_thresholds(values: np.ndarray, weights: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """At most some ``splits`` thresholds between the distinct values, of about equal weight."""
    there = values != 0.0
    distinct, place = np.unique(values[there], return_inverse=True)
    sums = np.bincount(place, weights[there], len(distinct))
    zeros = expected - sums.sum()
    if len(distinct) and zeros > np.finfo(float).eps * there.sum() * 100:
        at = np.searchsorted(distinct, 0.0)
        distinct, sums = np.insert(distinct, at, 0.0), np.insert(sums, at, zeros)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    stride, found, so_far = expected / (splits + 1), [], sums[0]
    target = stride
    for k, add in enumerate(sums[1:]):
        before, so_far = so_far, so_far + add
        if abs(before - target) < abs(so_far - target):
            found.append(middles[k])
            target += stride
    return np.array(found)


class Layout:
    """Cells of a histogram: the bins of each numeric feature, then a cell for each binary one, which counts its ones, then
    an unused one. A row lies in one cell for each numeric feature and for each binary one that it has."""

    def __init__(self, size: int, numeric: dict[int, np.ndarray], binary: list[int]):
        self.size, self.numeric, self.thresholds = size, np.array(list(numeric), int), list(numeric.values())
        self.binary = np.array(binary, int)
        bins = np.array([len(t) + 1 for t in self.thresholds], int)
        self.offsets = np.cumsum(bins) - bins
        self.dense = int(bins.sum())
        self.unused = self.dense + len(binary)
        width = int(bins.max()) if len(bins) else 1
        self.table = np.where(np.arange(width) < bins[:, None], self.offsets[:, None] + np.arange(width), self.unused)
        self.splits = np.arange(width - 1) < bins[:, None] - 1

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = np.uint16 if self.unused < 1 << 16 else np.uint32
        bins = np.empty((len(x), len(self.numeric)), kind)
        for k, (f, t) in enumerate(zip(self.numeric, self.thresholds)):
            bins[:, k] = np.searchsorted(t, x[:, f], "left") + self.offsets[k]
        flags = x[:, self.binary]
        if not np.isin(flags, (0.0, 1.0)).all():
            raise ValueError("a feature with two categories holds another value than 0 and 1")
        row, which = np.nonzero(flags)
        held = np.bincount(row, minlength=len(x))
        ones = np.full((len(x), int(held.max(initial=0))), self.unused, kind)
        ones[row, np.arange(len(row)) - (np.cumsum(held) - held)[row]] = which + self.dense
        return bins, ones


# --- tasks -------------------------------------------------------------------------------------------------------


class _Meeting:
    """The tasks of a stage, which pass pieces of bytes through a folder: all to the first one, and that one to all."""

    def __init__(self, folder: str, tasks: int):
        context = BarrierTaskContext.get()
        self.rank, self.tasks, self.step, self.parent = context.partitionId(), tasks, 0, os.getppid()
        # where a task is lost, Spark starts all of them again, and none may meet the pieces of the ones before
        self.folder = f"{folder}/{context.allGather(str(context.taskAttemptId()))[0]}"
        os.makedirs(self.folder, exist_ok=True)

    def _write(self, name: str, content: bytes) -> None:
        with open(f"{self.folder}/.{name}", "wb") as f:
            f.write(content)
        os.replace(f"{self.folder}/.{name}", f"{self.folder}/{name}")

    def _read(self, name: str, until: float = math.inf) -> bytes | None:
        tries = 0
        while True:
            try:
                with open(f"{self.folder}/{name}", "rb") as f:
                    return f.read()
            except FileNotFoundError:
                tries += 1
                if time.monotonic() > until:
                    return None
                if tries % 1000 == 0 and os.getppid() != self.parent:
                    raise RuntimeError("the executor ended") from None
                time.sleep(0.0005)

    def all_here(self) -> bool:
        until = time.monotonic() + MEET_S
        self._write(f"here-{self.rank}", b"")
        if self.rank:
            return self._read("begin", until + MEET_S) is not None
        if any(self._read(f"here-{k}", until) is None for k in range(self.tasks)):
            return False
        self._write("begin", b"")
        return True

    def sum(self, values: np.ndarray, answer) -> object:
        """What ``answer`` says, at the first task, to the sums over all tasks, added in their order."""
        self.step += 1
        if self.rank:
            self._write(f"{self.step}-{self.rank}", values.tobytes())
            return pickle.loads(self._read(f"{self.step}-all"))
        for k in range(1, self.tasks):
            values = values + np.frombuffer(self._read(name := f"{self.step}-{k}")).reshape(values.shape)
            os.remove(f"{self.folder}/{name}")
        said = answer(values)
        if self.tasks > 1:
            self._write(f"{self.step}-all", pickle.dumps(said))
            if self.step > 1:  # all have read it, or they could not have told this step
                os.remove(f"{self.folder}/{self.step - 1}-all")
        return said


class _Rows:
    """Binned rows of a task: cells, label of -1 or 1, weight."""

    def __init__(self, batches: Iterator[pa.RecordBatch], layout: Layout):
        parts = []
        for b in batches:
            x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, layout.size)
            parts.append((*layout.cells(x), b["_y"].to_numpy(zero_copy_only=False), b["_w"].to_numpy(zero_copy_only=False)))
        width = max((p[1].shape[1] for p in parts), default=0)
        self.columns, self.cell_count = len(layout.numeric), layout.unused + 1
        n = sum(len(p[2]) for p in parts)
        self.cells = np.full((n, self.columns + width), layout.unused, np.uint16 if layout.unused < 1 << 16 else np.uint32)
        self.label, self.weight, at = np.empty(n), np.empty(n), 0
        while parts:
            bins, ones, y, w = parts.pop()
            here = slice(at, at := at + len(y))
            self.cells[here, :self.columns], self.cells[here, self.columns:self.columns + ones.shape[1]] = bins, ones
            self.label[here], self.weight[here] = y, w
        if not np.isin(self.label, (0.0, 1.0)).all():
            raise ValueError("labels of boosted trees must be 0 or 1")
        self.label = 2.0 * self.label - 1.0
        self.margin = np.zeros(n)

    def aim(self, first: bool) -> None:
        """What the next tree is fitted to: the label, then the negative gradient of the logistic loss."""
        with np.errstate(over="ignore"):
            self.target = self.label if first else 4.0 * self.label / (1.0 + np.exp(2.0 * self.label * self.margin))
        self.weighted = self.weight * self.target

    def totals(self, at: np.ndarray) -> tuple[float, float, float, float]:
        wt = self.weighted[at]
        return len(at), self.weight[at].sum(), wt.sum(), (wt * self.target[at]).sum()

    def histogram(self, at: np.ndarray) -> np.ndarray:
        """Number, weight and weighted target of rows by cell."""
        out, width, n = np.zeros((3, self.cell_count)), self.cells.shape[1], self.cell_count
        for a in range(0, len(at), CHUNK):
            some = at[a:a + CHUNK]
            cells = self.cells[some].ravel().astype(np.intp)
            out[0] += np.bincount(cells, minlength=n)
            out[1] += np.bincount(cells, np.repeat(self.weight[some], width), n)
            out[2] += np.bincount(cells, np.repeat(self.weighted[some], width), n)
        return out

    def parted(self, at: np.ndarray, column: int, cell: int, ones_left: bool) -> tuple[np.ndarray, np.ndarray]:
        left = self.cells[at, column] <= cell if column >= 0 else (
            self.cells[at, self.columns:] == cell).any(1) == ones_left
        return at[left], at[~left]


class _Tree:
    """A tree while it grows, at the first task: ``nodes`` as told to ``NODES``, and the histograms of the open ones."""

    def __init__(self, layout: Layout, depth: int, least: int, least_gain: float):
        self.layout, self.depth, self.least, self.least_gain = layout, depth, least, least_gain
        self.level, self.nodes, self.open, self.parents = 0, [{}], [0], []

    def answer(self, values: np.ndarray, built: list[bool]) -> list:
        """What becomes of each open node: ``(None, value)`` of a leaf, or its split and whether the left part of it is
        looked at next; the right one is what is left of it."""
        n = len(self.open)
        totals, sums = values[:4 * n].reshape(n, 4), iter(values[4 * n:].reshape(-1, 3, self.layout.unused + 1))
        if self.level < self.depth:
            found = [next(sums) if b else None for b in built]
            for k, whole in enumerate(self.parents):
                a, b = found[2 * k:2 * k + 2]
                found[2 * k:2 * k + 2] = (a, whole - a) if b is None else (whole - b, b)
            histograms = np.stack(found)
            best, gains, left = self.splits(histograms, totals)
        said, following, self.parents = [], [], []
        for k, (number, (count, w, s, ss)) in enumerate(zip(self.open, totals)):
            impurity = (ss - s * s / w) / w if w else 0.0
            node = self.nodes[number]
            node.update(prediction=s / w if w else 0.0, impurity=impurity, stats=[w, s, ss], count=int(count))
            if self.level == self.depth or abs(impurity) < np.finfo(float).eps or not (
                    gains[k] > 1e-13 * ss / w and gains[k] >= self.least_gain):
                said.append((None, node["prediction"]))
                continue
            where, cut, feature, kept = best[k]
            cell, ones_left = int(self.layout.dense + where), left[k]
            if cut >= 0:
                cell = int(self.layout.offsets[where] + cut)
                split = (feature, [float(self.layout.thresholds[where][cut])], -1)
            else:
                split = (feature, [float(ones_left)], 2)
            small = bool(2 * kept <= count)
            said.append(((int(where) if cut >= 0 else -1, cell, bool(ones_left)), small))
            node.update(split=split, gain=float(gains[k]), children=(len(self.nodes), len(self.nodes) + 1))
            following += node["children"]
            self.nodes += [{}, {}]
            self.parents.append(histograms[k])
        self.open, self.level = following, self.level + 1
        return said

    def splits(self, h: np.ndarray, totals: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
        """The best split of each node: the first feature of the highest gain. ``(place, cut or -1, feature, rows left)``."""
        layout, n = self.layout, len(h)
        all_w, all_s = totals[:, 1, None], totals[:, 2, None]
        h[:, :, layout.unused] = 0.0

        def gain(count, w, s, rest, rest_w, rest_s):
            valid = (count >= self.least) & (rest >= self.least) & (w > 0) & (rest_w > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                whole = (all_s * all_s / all_w / all_w).reshape(n, *[1] * (count.ndim - 1))
                parts = (s * s / w + rest_s * rest_s / rest_w) / all_w.reshape(n, *[1] * (count.ndim - 1))
            return np.where(valid, parts - whole, -np.inf)

        by_feature, cuts = np.full((n, layout.size), -np.inf), None
        if len(layout.numeric):
            up_to = np.cumsum(h[:, :, layout.table], axis=3)
            below, above = up_to[..., :-1], up_to[..., -1:] - up_to[..., :-1]
            of_cuts = np.where(layout.splits, gain(*np.moveaxis(below, 1, 0), *np.moveaxis(above, 1, 0)), -np.inf)
            cuts = _first_best(of_cuts)
            by_feature[:, layout.numeric] = np.take_along_axis(of_cuts, cuts[..., None], 2)[..., 0]
        ones = h[:, :, layout.dense:layout.unused]
        zeros = totals[:, :3, None] - ones
        by_feature[:, layout.binary] = gain(*np.moveaxis(ones, 1, 0), *np.moveaxis(zeros, 1, 0))
        features = _first_best(by_feature)
        best, ones_left = [], np.zeros(n, bool)
        for k, f in enumerate(features):
            (where,) = np.nonzero(layout.numeric == f)
            if len(where):
                cut = cuts[k, where[0]]
                best.append((where[0], cut, int(f), below[k, 0, where[0], cut]))
                continue
            (where,) = np.nonzero(layout.binary == f)
            if not len(where):  # a constant feature: none can be split
                best.append((0, -1, int(f), 0))
                continue
            one, zero = ones[k, :, where[0]], zeros[k, :, where[0]]
            with np.errstate(divide="ignore", invalid="ignore"):
                ones_left[k] = one[2] / one[1] < zero[2] / zero[1]  # the category with the lower mean goes left
            best.append((where[0], -1, int(f), one[0] if ones_left[k] else zero[0]))
        return best, np.take_along_axis(by_feature, features[:, None], 1)[:, 0], ones_left

    def stored(self, tree: int) -> list[dict]:
        """Nodes numbered from the top, left parts first; a split whose two leaves predict the same is a leaf."""
        out = []

        def same(node):
            children = [self.nodes[c] for c in node.get("children", ())]
            for c in children:
                same(c)
            if children and not any("children" in c for c in children) and len({c["prediction"] for c in children}) == 1:
                del node["children"]

        def put(node) -> int:
            out.append(row := {"id": len(out), "prediction": node["prediction"], "impurity": node["impurity"],
                               "impurityStats": node["stats"], "rawCount": node["count"], "gain": -1.0, "leftChild": -1,
                               "rightChild": -1,
                               "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}})
            if "children" in node:
                feature, left, categories = node["split"]
                row |= {"gain": node["gain"], "split": {
                    "featureIndex": feature, "leftCategoriesOrThreshold": left, "numCategories": categories}}
                row["leftChild"], row["rightChild"] = [put(self.nodes[c]) for c in node["children"]]
            return row["id"]

        same(self.nodes[0])
        put(self.nodes[0])
        return [{"treeID": tree, "nodeData": row} for row in out]


def _first_best(gains: np.ndarray) -> np.ndarray:
    """Place of the highest gain; the first one where the difference is that of rounding."""
    top = gains.max(axis=-1, keepdims=True)
    return np.argmax(gains >= np.where(np.isfinite(top), top - 1e-10 * np.abs(top), top), axis=-1)


def _grow(batches: Iterator[pa.RecordBatch], layout: Layout, folder: str, tasks: int, rounds: int, depth: int, rate: float,
          least: int, least_gain: float) -> Iterator[pa.RecordBatch]:
    meeting = _Meeting(folder, tasks)
    if not meeting.all_here():
        return
    rows, nodes = _Rows(batches, layout), []
    for k in range(rounds):
        rows.aim(k == 0)
        tree = _Tree(layout, depth, least, least_gain)
        parts, built, level = [np.arange(len(rows.label))], [depth > 0], 0
        while parts:
            told = [np.array([rows.totals(at) for at in parts]).ravel()]
            told += [rows.histogram(at).ravel() for at, b in zip(parts, built) if b]
            said = meeting.sum(np.concatenate(told), lambda v: tree.answer(v, built))
            last, parts, built, level = parts, [], [], level + 1
            for at, (split, more) in zip(last, said):
                if split is None:
                    rows.margin[at] += (1.0 if k == 0 else rate) * more
                else:
                    parts += rows.parted(at, *split)
                    built += [more and level < depth, not more and level < depth]
        if meeting.rank == 0:
            nodes += tree.stored(k)
    if meeting.rank == 0:
        yield pa.RecordBatch.from_pylist(nodes, NODES_ARROW)


NODES_ARROW = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                         ("numCategories", pa.int32())]))]))])
