import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stayloom.plans import boosting, ml


def vectors(spark, rows, partitions=3):
    """Two numbers, one of them mostly zero, a constant and the slots of a category of five values."""
    mix = F.xxhash64("id") % 1000
    df = spark.range(rows).select(
        "id", (mix / 7).alias("a"), F.greatest(F.lit(0), (F.xxhash64("id", F.lit(1)) % 40 - 25)).cast("double").alias("b"),
        F.lit(3.0).alias("k"), F.concat(F.lit("v"), (F.abs(F.xxhash64("id", F.lit(2))) % 5).cast("string")).alias("c"))
    noise = F.abs(F.xxhash64("id", F.lit(3))) % 100
    df = df.withColumn("y", ((F.col("a") + 10 * F.col("b") + F.when(F.col("c") == "v2", 90).otherwise(0) + noise) > 60).cast("int"))
    df = df.withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(0.6))
    made = Pipeline(stages=[
        StringIndexer(inputCol="c", outputCol="ci"), OneHotEncoder(inputCol="ci", outputCol="cv", dropLast=False),
        VectorAssembler(inputCols=["a", "b", "k", "cv"], outputCol="features")]).fit(df).transform(df)
    return made.select("id", "features", "y", "w").repartition(partitions, "id").sortWithinPartitions("id")


def booster(kind=boosting.Boosting, **more):
    return kind(featuresCol="features", labelCol="y", weightCol="w", maxDepth=4, stepSize=0.1, seed=7, **more)


def chances(model, df):
    rows = model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).orderBy("id").collect()
    return np.array([r.p for r in rows])


@pytest.mark.parametrize("rows, tasks", [(700, 1), (700, 4), (14_000, 3)])  # above 10,000 rows candidates are sampled
def test_held_rows_give_the_trees_of_spark_ml(spark, monkeypatch, rows, tasks):
    monkeypatch.setattr(boosting, "LEAST_ROWS", -(-rows // tasks))
    df = vectors(spark, rows)
    own, theirs = booster(maxIter=6).fit(df), booster(GBTClassifier, maxIter=6).fit(df)
    assert np.abs(chances(own, df) - chances(theirs, df)).max() < 1e-9
    assert (own.getNumTrees, own.treeWeights, own.numFeatures) == (6, theirs.treeWeights, theirs.numFeatures)
    assert own.getMaxIter() == 6 and own.getLabelCol() == "y"
    assert np.abs(own.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 1e-9


def test_rounds_are_no_jobs(spark):
    """Spark ML runs some jobs for each level of each tree."""
    df, sc = vectors(spark, 400), spark.sparkContext
    sc.setJobGroup("rounds", "boosting")
    try:
        model = ml.candidate_models(400.0, boosting_rounds=25)["boosted_trees"].copy()
        model.setLabelCol("y").setWeightCol("w").fit(df)
        jobs = len(sc.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 75


def test_rows_that_are_not_held_are_left_to_spark_ml(spark, monkeypatch):
    df = vectors(spark, 300)
    held = chances(booster(maxIter=3).fit(df), df)
    monkeypatch.setattr(boosting, "_grow", lambda *a, **k: iter(()))  # the tasks did not meet
    assert np.abs(chances(booster(maxIter=3).fit(df), df) - held).max() < 1e-9
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "MOST_ROWS", 10)
    monkeypatch.setattr(boosting, "_thresholds", None)  # not reached
    assert np.abs(chances(booster(maxIter=3).fit(df), df) - held).max() < 1e-9


def test_one_class(spark):
    df = vectors(spark, 200)
    same = df.filter("y = 0")
    assert (chances(booster(maxIter=2).fit(same), same) == chances(booster(GBTClassifier, maxIter=2).fit(same), same)).all()
    assert booster(maxIter=2).fit(same).totalNumNodes == 2


def test_a_forest_stored_in_parts_is_the_forest(spark, tmp_path, monkeypatch):
    df = vectors(spark, 500)
    forest = RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=7, maxDepth=5, seed=3).fit(df)
    monkeypatch.setattr(ml, "STORED_NODES", forest.totalNumNodes // 3)
    ml.store_model(ml.PipelineModel(stages=[VectorAssembler(inputCols=["y"], outputCol="z"), forest]), str(tmp_path / "m"))
    read = ml.load_model(str(tmp_path / "m"), "").stages[-1]
    assert read.toDebugString.split("\n", 1)[1] == forest.toDebugString.split("\n", 1)[1]
    assert (read.getNumTrees, read.treeWeights, read.uid) == (7, forest.treeWeights, forest.uid)
    assert (read.getMaxDepth(), read.getLabelCol(), read.numClasses) == (5, "y", 2)
    assert (chances(read, df) == chances(forest, df)).all()


@pytest.mark.parametrize("kind", [LogisticRegression, RandomForestClassifier])
def test_models_can_be_used_after_an_observation(spark, kind):
    """A training summary holds the session, which cannot be sent to tasks once it has observed something."""
    df, seen = vectors(spark, 100), Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    model = ml.fitted(kind(featuresCol="features", labelCol="y"), df)
    assert not model.hasSummary and len(chances(model, df)) == 100
