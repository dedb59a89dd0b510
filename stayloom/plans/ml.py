"""Readmission models: training set, split, weights, scaling, fitting, exact evaluation, batch scores, risk bands."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clinical import risk_band
from ..functions.numbers import ratio, ratio_or_zero
from ..functions.text import as_category, inside_sql, strict_integer
from ..operators.order import running_total
from ..operators.selection import select_quantiles
from ..schema import (EXCLUDED_DISCHARGES, HIGH_RISK_QUANTILE, MEDIUM_RISK_QUANTILE, MODEL_CATEGORICAL, MODEL_NUMERIC,
                      MODEL_TARGET)
from ..session import shared_folder, staged
from . import trees
from .boosting import Boosting

SEED, TEST_SHARE = 42, 0.2

# --- data --------------------------------------------------------------------------------------------------------


def model_rows(encounters: DataFrame, target: bool = True) -> DataFrame:
    """Encounters a model may see: no death or hospice discharge; categories as text, NULL as a category."""
    kept = encounters.filter(~F.col("discharge_disposition_id").isin(*EXCLUDED_DISCHARGES))
    return kept.select(
        "encounter_id", *MODEL_NUMERIC, *(as_category(c).alias(c) for c in MODEL_CATEGORICAL),
        *([MODEL_TARGET] if target else []))


def split_quotas(rows: DataFrame, label: str, share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class: the share of all rows, rounded up, spread over the classes by largest remainder.

    One row per class, so the window over all of them is a handful of rows.
    """
    classes = rows.groupBy(label).agg(F.count("*").alias("class_rows"))
    everything = W.partitionBy()
    n = F.sum("class_rows").over(everything)
    sized = classes.withColumn("_n", n).withColumn("_test", F.ceil(F.col("_n") * share))
    exact = F.col("_test") * F.col("class_rows")  # numerator over _n
    whole = F.floor(exact / F.col("_n"))
    sized = sized.withColumn("_whole", whole).withColumn("_rest", exact % F.col("_n"))
    missing = F.col("_test") - F.sum("_whole").over(everything)
    place = F.row_number().over(W.partitionBy().orderBy(F.desc("_rest"), label))
    return sized.withColumn("_place", place).withColumn("_missing", missing).select(
        label, "class_rows", (F.col("_whole") + (F.col("_place") <= F.col("_missing")).cast("int")).alias("test_rows"))


def stratified_split(rows: DataFrame, key: str, label: str, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Exact stratified split: the rows of each class in hashed-key order, the first of them to the test set.

    Returns ``(key, label, is_test)``. The order is global, so a class holding nearly all rows is no hot group.
    """
    hashed = rows.select(key, label, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("_hash"),
                         F.lit(1).alias("_one"))
    ranked = running_total(hashed, ["_hash", key], {"_rank": "_one"}, [label])
    quotas = split_quotas(rows, label, share).select(F.col(label).alias("_label"), "test_rows")
    return ranked.join(quotas, ranked[label].eqNullSafe(F.col("_label"))).select(
        key, label, (F.col("_rank") <= F.col("test_rows")).cast("int").alias("is_test"))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes · n_class), and the ratio of the other rows to the rows of the class."""
    counts = rows.groupBy(label).agg(F.count("*").alias("class_rows"))
    n, k = F.sum("class_rows").over(W.partitionBy()), F.count("*").over(W.partitionBy())  # a row per class
    return counts.select(
        label, "class_rows", ratio(n, k * F.col("class_rows")).alias("class_weight"),
        ratio(n - F.col("class_rows"), F.col("class_rows")).alias("others_ratio"))


def scaling(rows: DataFrame, columns: Sequence[str] = MODEL_NUMERIC) -> DataFrame:
    """Mean and population standard deviation per column from whole-number sums; a constant column gets 1."""
    def moments(c):
        n, x = F.count(c), F.col(c).cast("decimal(18,0)")
        s, ss = F.sum(x), F.sum((x * x).cast("decimal(28,0)"))
        wide = (n.cast("decimal(18,0)") * ss - (s * s).cast("decimal(38,0)")).cast("double")
        std = F.sqrt(wide) / n
        return F.struct(F.lit(c).alias("column_name"), ratio(s, n).alias("mean"),
                        F.when(std > 0, std).otherwise(1.0).alias("std"))

    return rows.agg(F.array(*map(moments, columns)).alias("m")).select(F.inline("m"))


def standardise(rows: DataFrame, columns: Sequence[str] = MODEL_NUMERIC) -> DataFrame:
    """Columns replaced by their standard scores. The scaling arrives as a scalar subquery, not over the driver."""
    by_name = scaling(rows, columns).agg(F.map_from_entries(F.collect_list(F.struct(
        "column_name", F.struct("mean", "std")))).alias("m")).scalar()
    others = [c for c in rows.columns if c not in columns]
    scaled = rows.withColumn("_m", by_name)
    return scaled.select(*others, *(
        ((F.col(c) - F.col("_m")[c]["mean"]) / F.col("_m")[c]["std"]).alias(c) for c in columns))


# --- models ------------------------------------------------------------------------------------------------------


#: Rows of a fit are dealt by key over a number of partitions that follows from the number of rows: forests draw their
#: samples per partition, so the fitted model must not depend on files or cores. A round of boosting is a handful of jobs of
#: that many tasks; there are at least so many, and no more rows in one as the training set grows.
TRAIN_PARTITIONS = 4
TRAIN_ROWS = 50_000
TREE_DEPTHS = {"random_forest": 12, "boosted_trees": 6}
#: Memory for the histograms of the nodes that one job grows; more of it means fewer jobs for a tree.
NODE_MEMORY_MB = 1024
#: Nodes of a forest that Spark ML's writer gets at a time.
STORED_NODES = 60_000


def preprocessing(train: DataFrame) -> list:
    """Stages: standard scores, one-hot categories with unseen values as all zeros, one vector."""
    moments = scaling(train).collect()  # one row per declared numeric column
    scores = ", ".join(f"({m['column_name']} - {m['mean']!r}D) / {m['std']!r}D AS {m['column_name']}_z"
                       for m in moments)
    indexed = [f"{c}_i" for c in MODEL_CATEGORICAL]
    encoded = [f"{c}_v" for c in MODEL_CATEGORICAL]
    return [
        SQLTransformer(statement=f"SELECT *, {scores} FROM __THIS__"),
        # an unseen value gets the index after the last, which dropLast turns into all zeros
        StringIndexer(inputCols=list(MODEL_CATEGORICAL), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*(f"{c}_z" for c in MODEL_NUMERIC), *encoded], outputCol="features"),
    ]


def candidate_models(weight_sum: float, forest_trees: int = 300, boosting_rounds: int = 300) -> dict:
    """The three candidates. The L2 strength of C = 1 is one over the summed row weights."""
    shared = dict(featuresCol="features", labelCol=MODEL_TARGET, weightCol="class_weight")
    grown = dict(seed=SEED, maxMemoryInMB=NODE_MEMORY_MB, **shared)
    return {
        "logistic_regression": LogisticRegression(
            maxIter=1000, regParam=1.0 / weight_sum, elasticNetParam=0.0, standardization=False, **shared),
        "random_forest": RandomForestClassifier(
            numTrees=forest_trees, maxDepth=TREE_DEPTHS["random_forest"], cacheNodeIds=True, **grown),
        # one shallow tree at a time: walking down from its root costs less than a table of node ids for every level
        "boosted_trees": Boosting(maxIter=boosting_rounds, maxDepth=TREE_DEPTHS["boosted_trees"], stepSize=0.05, **grown),
    }


def weighted(rows: DataFrame, label: str = MODEL_TARGET) -> DataFrame:
    weights = class_weights(rows, label).select(F.col(label).alias("_label"), "class_weight")
    return rows.join(F.broadcast(weights), F.col(label) == F.col("_label")).drop("_label")  # a row per class


def train_partitions(rows: int) -> int:
    return max(TRAIN_PARTITIONS, math.ceil(rows / TRAIN_ROWS))


def training_vectors(train: DataFrame, partitions: int | None = None) -> tuple[list, DataFrame]:
    """Fitted preprocessing stages and their output, written once for all candidates and dealt by key."""
    rows = weighted(train)
    shared = Pipeline(stages=preprocessing(train)).fit(rows)
    vectors = staged(shared.transform(rows).select("encounter_id", "features", MODEL_TARGET, "class_weight"), "vectors")
    dealt = vectors.repartition(partitions or train_partitions(vectors.count()), "encounter_id").sortWithinPartitions(
        "encounter_id")
    return shared.stages, dealt.select("features", MODEL_TARGET, "class_weight")


def fitted(candidate, vectors: DataFrame):
    """The fitted model without its training summary. The summary holds the session, and a model with it cannot be sent to
    tasks once the session has observed a metric."""
    model = candidate.fit(vectors)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(vectors.sparkSession.sparkContext._jvm.scala.Option.apply(None))
    return model


def fit_candidates(train: DataFrame, names: Sequence[str] | None = None, partitions: int | None = None,
                   **sizes: int) -> dict[str, PipelineModel]:
    """Fit the preprocessing once and every wanted candidate on its output; each result is a complete pipeline."""
    stages, vectors = training_vectors(train, partitions)
    # balanced weights add up to the number of rows
    candidates = candidate_models(float(train.count()), **sizes)
    return {name: PipelineModel(stages=[*stages, fitted(candidates[name], vectors)]) for name in names or candidates}


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probability of readmission and predicted class per row."""
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    kept = [c for c in ("encounter_id", MODEL_TARGET) if c in rows.columns]
    return scored.select(*kept, F.col("prediction").cast("int").alias("y_pred"), "score")


# --- evaluation --------------------------------------------------------------------------------------------------


def confusion(scored: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    return scored.agg(
        F.count_if(~t & ~p).alias("true_negative"), F.count_if(~t & p).alias("false_positive"),
        F.count_if(t & ~p).alias("false_negative"), F.count_if(t & p).alias("true_positive"))


def class_metrics(scored: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """Confusion matrix, precision, recall, sensitivity, specificity, F1; 0 where a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive"))
    return confusion(scored, truth, predicted).select(
        "*",
        F.round(ratio_or_zero(tp, tp + fp), 4).alias("precision"),
        F.round(ratio_or_zero(tp, tp + fn), 4).alias("recall"),
        F.round(ratio_or_zero(tp, tp + fn), 4).alias("sensitivity"),
        F.round(ratio_or_zero(tn, tn + fp), 4).alias("specificity"),
        F.round(ratio_or_zero(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"))


def ranking_metrics(scored: DataFrame, truth: str = "y_true", score_column: str = "score") -> DataFrame:
    """Exact area under the ROC curve and average precision.

    Rows collapse to one row per distinct score before the global running totals; ties count half for the ROC area
    and are one threshold for the precision.
    """
    groups = scored.groupBy((-F.col(score_column)).alias("_down")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
    curve = running_total(groups, ["_down"], {"tp": "pos", "fp": "neg"})
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    # twice the ROC area, in whole numbers
    area = F.sum((neg.cast("decimal(18,0)") * (2 * (tp - pos) + pos).cast("decimal(19,0)")).cast("decimal(38,0)"))
    p, n = F.sum("pos"), F.sum("neg")
    precision = F.sum(pos * (tp / (tp + fp)))
    return curve.agg(
        ratio(area, 2 * p.cast("decimal(18,0)") * n).alias("roc_auc"),
        (precision / p).alias("pr_auc"),
    ).select(F.round("roc_auc", 4).alias("roc_auc"), F.round("pr_auc", 4).alias("pr_auc"))


def evaluation(scored: DataFrame, truth: str = "y_true", predicted: str = "y_pred",
               score_column: str = "score") -> DataFrame:
    """All metrics of one model in one row."""
    areas = ranking_metrics(scored, truth, score_column)
    both = areas.select(F.struct("roc_auc", "pr_auc").alias("a")).scalar()
    return class_metrics(scored, truth, predicted).withColumn("_a", both).select("*", "_a.roc_auc", "_a.pr_auc").drop(
        "_a")


def compare(evaluations: dict[str, DataFrame]) -> DataFrame:
    """Metrics per model, and which one is best by ROC area (the first one on ties)."""
    out = None
    for i, (name, row) in enumerate(evaluations.items()):
        one = row.select(F.lit(name).alias("model_name"), F.lit(i).alias("_order"), "*")
        out = one if out is None else out.unionByName(one)
    best = out.agg(F.max_by("model_name", F.struct("roc_auc", -F.col("_order"))).alias("m")).scalar()
    return out.withColumn("is_best", F.col("model_name") == best).drop("_order")


def _finished(spark: SparkSession, folder: str) -> DataFrame | None:
    """A report that an earlier run wrote to its end, if there is one."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException:  # no such folder, or a write that did not end
        return None


def train_and_store(train: DataFrame, test: DataFrame, folder: str, partitions: int | None = None,
                    **sizes: int) -> tuple[str, DataFrame]:
    """Fit all candidates, store them below ``folder`` and write the evaluation report beside them.

    Each candidate is a job of its own: its model, then its metrics on the held-out rows, which are scored once. A run
    that is started again on the same folder goes on with the first candidate that has no metrics. Returns the name of
    the best model by ROC area and the report.
    """
    spark, evaluations, prepared = train.sparkSession, {}, None
    candidates = candidate_models(float(train.count()), **sizes)
    for name, candidate in candidates.items():
        path = f"{folder}/metrics/{name}"
        if _finished(spark, path) is None:
            stages, vectors = prepared = prepared or training_vectors(train, partitions)
            model = PipelineModel(stages=[*stages, fitted(candidate, vectors)])
            store_model(model, f"{folder}/{name}")
            if name in TREE_DEPTHS:
                _store_trees(spark, folder, name, len(model.stages) - 1)
            scored = staged(score(model, test).withColumnRenamed(MODEL_TARGET, "y_true"), "held-out-scores")
            evaluation(scored).write.mode("overwrite").parquet(path)
        evaluations[name] = spark.read.parquet(path)
    compare(evaluations).write.mode("overwrite").parquet(f"{folder}/evaluation")
    report = spark.read.parquet(f"{folder}/evaluation")
    return report.filter("is_best").first()["model_name"], report  # one row


def _stage_folder(spark: SparkSession, path: str, stage: int) -> str:
    """Folder of a stage of the pipeline stored at ``path``."""
    # a stored pipeline numbers the folders of its stages, with as many digits as the number of stages has
    (place,) = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        f"{path}/stages").select(F.regexp_extract("path", f"^(.*/stages/0*{stage}_[^/]+)/", 1).alias("path"))
        .filter("path <> ''").distinct().collect()]  # one folder
    return place


def store_model(model: PipelineModel, path: str) -> None:
    """Store a fitted pipeline. A large forest is handed to Spark ML's writer some trees at a time, and the parts become the
    stored forest: the writer makes one local table of all nodes on the driver."""
    forest = model.stages[-1]
    if not isinstance(forest, RandomForestClassificationModel) or forest.totalNumNodes <= STORED_NODES:
        model.write().overwrite().save(path)
        return
    sc = SparkContext.getOrCreate()
    spark, jvm = SparkSession.builder.getOrCreate(), sc._jvm
    whole, parts, held = forest._java_obj, [], 0
    for tree in whole.trees():
        held += (nodes := tree.numNodes())
        if not parts or held > STORED_NODES:
            parts, held = [*parts, []], nodes
        parts[-1].append(tree)
    stored, folder = [], f"{shared_folder(spark)}/scratch/forest-{uuid.uuid4().hex}"
    for k, part in enumerate(parts):
        some = sc._gateway.new_array(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(part))
        for i, tree in enumerate(part):
            some[i] = tree
        of_part = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
            forest.uid, some, forest.numFeatures, forest.numClasses)
        whole.copyValues(of_part, jvm.org.apache.spark.ml.param.ParamMap())
        of_part.write().save(f"{folder}/{k}")
        stored.append((f"{folder}/{k}", sum(map(len, parts[:k]))))
        if k == 0:
            PipelineModel(stages=[*model.stages[:-1], RandomForestClassificationModel(of_part)]).write().overwrite().save(path)
    place = _stage_folder(spark, path, len(model.stages) - 1)
    for name, number in (("data", "treeID"), ("treesMetadata", "_1")):
        tables = [spark.read.parquet(f"{at}/{name}").withColumn(number, F.col(number) + first) for at, first in stored]
        reduce(DataFrame.unionByName, tables).write.mode("overwrite").parquet(f"{place}/{name}")
    about = json.loads(spark.read.text(f"{place}/metadata").first()["value"]) | {"numTrees": forest.getNumTrees}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{place}/metadata")


def _store_trees(spark: SparkSession, folder: str, name: str, stage: int) -> None:
    """The trees of a stored candidate as tables: ``trees/<name>/nodes`` and ``trees/<name>/leaves``."""
    place, out = _stage_folder(spark, f"{folder}/{name}", stage), f"{folder}/trees/{name}"
    trees.node_table(spark, place, name == "boosted_trees").write.mode("overwrite").parquet(f"{out}/nodes")
    nodes = spark.read.parquet(f"{out}/nodes")
    trees.leaf_table(nodes, TREE_DEPTHS[name]).write.mode("overwrite").parquet(f"{out}/leaves")


def rescore(folder: str, name: str, rows: DataFrame) -> DataFrame:
    """Scores of a stored ensemble from its node table, by SQL expressions: ``encounter_id, score``."""
    vectors = PipelineModel(stages=load_model(folder, name).stages[:-1]).transform(rows)
    nodes = rows.sparkSession.read.parquet(f"{folder}/trees/{name}/nodes")
    return trees.rescored(vectors.select("encounter_id", "features"), nodes, TREE_DEPTHS[name],
                          name == "boosted_trees").select("encounter_id", "score")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}")


def category_slots(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Slot that each category of ``rows`` takes in its one-hot vector, NULL where the vector is all zeros:
    ``(encounter_id, column_name, slot)``. Vectors are fitted on ``train``."""
    fitted = Pipeline(stages=preprocessing(train)).fit(train).transform(rows)
    slots = [F.struct(F.lit(c).alias("column_name"), F.nullif(
        F.array_position(vector_to_array(f"{c}_v"), F.lit(1.0)), F.lit(0)).alias("place")) for c in MODEL_CATEGORICAL]
    return fitted.select("encounter_id", F.inline(F.array(*slots))).select(
        "encounter_id", "column_name", (F.col("place") - 1).alias("slot"))


# --- scoring -----------------------------------------------------------------------------------------------------


def risk_thresholds(scored: DataFrame, score_column: str = "score") -> DataFrame:
    """Exact 80 % and 95 % quantiles of the scores, linearly interpolated: one row. Scans run here: pass stored scores."""
    found = select_quantiles(scored.select(F.col(score_column).alias("score")), ["score"], {
        "medium_threshold": MEDIUM_RISK_QUANTILE, "high_threshold": HIGH_RISK_QUANTILE})["score"]
    return scored.sparkSession.range(1).select(*(F.lit(x).cast("double").alias(name) for name, x in found.items()))


def with_risk_band(scored: DataFrame, thresholds: DataFrame, score_column: str = "score") -> DataFrame:
    """Band of each score against stored thresholds."""
    limits = thresholds.select(F.struct("medium_threshold", "high_threshold").alias("t")).scalar()
    return scored.withColumn("_t", limits).withColumn("predicted_risk_category", risk_band(
        score_column, F.col("_t.medium_threshold"), F.col("_t.high_threshold"))).drop("_t")


def fact_prediction(scored: DataFrame, model_name: str, model_version: str, as_of: str) -> DataFrame:
    banded = with_risk_band(scored, risk_thresholds(scored))
    return banded.select(
        F.col("encounter_id").alias("encounter_key"), F.col("score").alias("predicted_probability"),
        "predicted_risk_category", F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        F.to_timestamp(F.lit(as_of)).alias("predicted_at"))


def band_distribution(banded: DataFrame) -> DataFrame:
    return banded.groupBy("predicted_risk_category").agg(F.count("*").alias("rows"))


def risk_kpis(predictions: DataFrame) -> DataFrame:
    """High-risk encounters and mean predicted probability; a prediction exists once per encounter."""
    return predictions.agg(
        F.count_if(F.col("predicted_risk_category") == "High").alias("high_risk"),
        F.avg("predicted_probability").alias("mean_probability"))


def outcome_by_band(predictions: DataFrame, outcomes: DataFrame, key: str, truth: str) -> DataFrame:
    """Actual rate per predicted band."""
    return predictions.join(outcomes.select(key, truth), key).groupBy("predicted_risk_category").agg(
        F.count("*").alias("encounters"), F.avg(truth).alias("actual_rate"))


# --- scoring of requests -------------------------------------------------------------------------------------------

# The accepted range of each numeric request field.
REQUEST_BOUNDS = {
    **{c: (0, None) for c in MODEL_NUMERIC},
    "time_in_hospital": (1, 14), "number_diagnoses": (1, 16), "age_midpoint": (0, 100), "insulin_prescribed": (0, 1),
}
#: Request fields that take any whole number; the remaining ones are texts.
REQUEST_CODES = ("admission_type_id", "discharge_disposition_id", "admission_source_id")
REQUEST_FIELDS = (*MODEL_NUMERIC, *MODEL_CATEGORICAL)


def request_violations(requests: DataFrame) -> DataFrame:
    """Why a scoring request would be refused: a row for each field that is absent, no whole number, or out of range.

    Requests hold every field as text beside their ``row_id``.
    """
    def broken(c):
        if c in REQUEST_BOUNDS:
            low, high = REQUEST_BOUNDS[c]
            wrong = F.expr(f"NOT {inside_sql(c, low, high)}")
            reason = f"{c} must be at least {low}" if high is None else f"{c} must be {low} to {high}"
        elif c in REQUEST_CODES:
            wrong, reason = strict_integer(c).isNull(), f"{c} must be a whole number"
        else:
            wrong, reason = F.lit(False), ""

        def finding(rule, value, text):
            return F.struct(F.lit(rule).alias("rule_name"), F.lit(c).alias("column_name"),
                            value.alias("invalid_value"), F.lit(text).alias("rejection_reason"))

        return F.when(F.col(c).isNull(), finding("required_value", F.lit("<NULL>"), f"{c} is required")).when(
            wrong, finding("invalid_numeric_value", F.col(c), reason))

    return requests.select("row_id", F.inline(F.array_compact(F.array(*map(broken, REQUEST_FIELDS)))))


def score_requests(model: PipelineModel, thresholds: DataFrame, requests: DataFrame, model_name: str) -> DataFrame:
    """Probability (4 places) and band of given feature rows against stored thresholds."""
    typed = requests.withColumns({c: as_category(c) for c in MODEL_CATEGORICAL})
    banded = with_risk_band(score(model, typed), thresholds)
    return banded.withColumn("predicted_probability", F.round("score", 4)).withColumn(
        "model_name", F.lit(model_name)).drop("score", "y_pred")
