import datetime
import hashlib
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayloom.operators import ledger
from stayloom.plans import legacy, ml, trees
from stayloom.sources import files


def scored(spark, truth, predicted, scores):
    return spark.createDataFrame(list(zip(truth, predicted, scores)), "y_true int, y_pred int, score double")


def test_perfect_classifier(spark):
    row = ml.evaluation(scored(spark, [0, 0, 1, 1], [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first()
    assert (row.roc_auc, row.pr_auc, row.precision, row.recall, row.true_positive, row.false_positive) == (
        1.0, 1.0, 1.0, 1.0, 2, 0)


def test_counts_add_up(spark):
    row = ml.evaluation(scored(spark, [0, 0, 1, 1, 1], [0, 1, 1, 0, 1], [0.2, 0.6, 0.7, 0.4, 0.9])).first()
    assert (row.true_negative, row.false_positive, row.false_negative, row.true_positive) == (1, 1, 1, 2)
    assert row.roc_auc == pytest.approx(5 / 6, abs=1e-4)


def test_ties_and_zero_denominators(spark):
    row = ml.evaluation(scored(spark, [0, 1, 0, 1], [0, 0, 0, 0], [0.5, 0.5, 0.5, 0.5])).first()
    assert (row.precision, row.recall, row.f1_score, row.roc_auc, row.pr_auc) == (0.0, 0.0, 0.0, 0.5, 0.5)


def test_areas_against_brute_force(spark):
    import random

    generator = random.Random(3)
    rows = [(int(generator.random() < 0.3), 0, generator.randrange(40) / 40) for _ in range(400)]
    row = ml.ranking_metrics(scored(spark, *zip(*rows))).first()
    pos, neg = [s for t, _, s in rows if t], [s for t, _, s in rows if not t]
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    precision = sum(
        sum(p == s for p in pos) / len(pos) * sum(p >= s for p in pos) / sum(r[2] >= s for r in rows)
        for s in set(pos))
    assert (row.roc_auc, row.pr_auc) == (pytest.approx(area, abs=6e-5), pytest.approx(precision, abs=6e-5))


@pytest.mark.parametrize("p, band", [(0.1, "Low"), (0.5, "Medium"), (0.6, "Medium"), (0.7, "High"), (0.9, "High")])
def test_bands(spark, p, band):
    limits = spark.createDataFrame([(0.5, 0.7)], "medium_threshold double, high_threshold double")
    df = spark.createDataFrame([(p,)], "score double")
    assert ml.with_risk_band(df, limits).first().predicted_risk_category == band


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).selectExpr("id", "CAST(id % 10 = 0 AS INT) AS y")
    first = ml.stratified_split(df, "id", "y")
    counts = {(r.y, r.is_test): r["count"] for r in first.groupBy("y", "is_test").count().collect()}
    assert counts[0, 1] + counts[1, 1] == 201 and counts[1, 1] == 20
    assert first.exceptAll(ml.stratified_split(df.repartition(3), "id", "y")).isEmpty()


def test_weights_and_scaling(spark):
    df = spark.createDataFrame([(0, 1, 5), (0, 3, 5), (0, 5, 5), (1, 7, 5)], "y int, a int, b int")
    weights = {r.y: (r.class_weight, r.others_ratio) for r in ml.class_weights(df, "y").collect()}
    assert weights == {0: (4 / 6, 1 / 3), 1: (2.0, 3.0)}
    got = {r.column_name: (r["mean"], r["std"]) for r in ml.scaling(df, ("a", "b")).collect()}
    assert got == {"a": (4.0, pytest.approx(5**0.5)), "b": (5.0, 1.0)}


def test_fit_score_and_requests(spark, layers):
    rows = layers.model_split()
    model = ml.fit_candidates(rows.filter("is_test = 0").drop("is_test"), ["logistic_regression"])["logistic_regression"]
    out = ml.score(model, rows.drop("is_test"))
    assert out.count() == rows.count() and out.filter("score NOT BETWEEN 0 AND 1").isEmpty()
    request = rows.limit(1).drop("is_test", "readmitted_30_days").withColumn("race", F.lit("never seen"))
    answer = ml.score_requests(model, ml.risk_thresholds(out), request, "logistic_regression").first()
    assert answer.predicted_risk_category in ("Low", "Medium", "High") and 0 <= answer.predicted_probability <= 1


def test_partitions_of_a_fit_follow_from_its_rows(layers, monkeypatch):
    train, _ = layers.train_and_test()
    rows = train.count()
    assert ml.training_vectors(train)[1].rdd.getNumPartitions() == ml.TRAIN_PARTITIONS
    monkeypatch.setattr(ml, "TRAIN_ROWS", 100)
    _, vectors = ml.training_vectors(train)
    assert vectors.rdd.getNumPartitions() == -(-rows // 100) > ml.TRAIN_PARTITIONS and vectors.count() == rows


def test_boosting_without_stored_node_ids_gives_the_same_trees(layers):
    _, vectors = ml.training_vectors(layers.train_and_test()[0])
    boosting = ml.candidate_models(float(vectors.count()), boosting_rounds=3)["boosted_trees"]
    assert not boosting.getCacheNodeIds()
    with_ids = boosting.copy({boosting.cacheNodeIds: True})
    one, other = (m.fit(vectors).toDebugString.split("\n", 1)[1] for m in (boosting, with_ids))
    assert one == other and "If (feature" in one


def test_training_goes_on_after_a_stop(spark, layers, tmp_path, monkeypatch):
    train, test = layers.train_and_test()
    fitted, candidates = [], ml.candidate_models

    class Watched:
        def __init__(self, name, model):
            self.name, self.model = name, model

        def fit(self, vectors):
            fitted.append(self.name)
            if self.name == "boosted_trees" and fitted.count("boosted_trees") == 1:
                raise RuntimeError("stopped")
            return self.model.fit(vectors)

    monkeypatch.setattr(ml, "candidate_models", lambda *a, **k: {
        n: Watched(n, m) for n, m in candidates(*a, **k).items()})
    with pytest.raises(RuntimeError):
        ml.train_and_store(train, test, str(tmp_path), forest_trees=3, boosting_rounds=2)
    best, report = ml.train_and_store(train, test, str(tmp_path), forest_trees=3, boosting_rounds=2)
    assert fitted == ["logistic_regression", "random_forest", "boosted_trees", "boosted_trees"]
    assert {r.model_name for r in report.collect()} == {"logistic_regression", "random_forest", "boosted_trees"}
    scored = ml.score(ml.load_model(str(tmp_path), best), test)
    assert scored.count() == test.count()


def test_ledger_state(spark):
    t = datetime.datetime(2024, 1, 1)
    runs = spark.createDataFrame([(1, "SUCCESS", t, t, 5), (2, "RUNNING", t, None, None)],
                                 "id int, status string, s timestamp, f timestamp, n int")
    events = ledger.opened(runs, "id", "s", []).unionByName(ledger.closed(runs, "id", "status", "f", ["n"]))
    got = {r.run_id: (r.status, r.finished_at, r.details.get("n")) for r in ledger.current_state(events).collect()}
    assert got == {1: ("SUCCESS", t, "5"), 2: ("RUNNING", None, None)}


def test_known_content_is_skipped(spark):
    history = spark.createDataFrame([(1, "a", "SUCCESS"), (2, "a", "SUCCESS"), (3, "b", "FAILED")],
                                    "id int, sha256 string, status string")
    new = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b")], "id int, sha256 string")
    got = {r.id: (r.decision, r.previous_import_id) for r in ledger.import_decisions(new, history).collect()}
    assert got == {10: ("SKIPPED", 2), 11: ("IMPORT", None), 12: ("SKIPPED", 11)}
    assert {r.id for r in ledger.to_import(new, history).collect()} == {11}


def test_file_admission_and_hash(spark, tmp_path):
    for name, content in (("diabetic_data.csv", b"abc"), ("other.csv", b"abc")):
        (tmp_path / name).write_bytes(content)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "diabetic_data.csv").write_bytes(b"")
    paths = [str(tmp_path / p) for p in ("diabetic_data.csv", "other.csv", "empty/diabetic_data.csv")]
    got = files.admission(files.given_files(spark, paths)).collect()
    assert {r.path: r.reject_reason for r in got} == dict(zip(paths, (None, "unexpected name", "empty file")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.given_files(spark, [str(tmp_path / "absent.csv")])
    hashes = files.file_hashes(spark, str(tmp_path), "other.csv").collect()
    assert [h.sha256 for h in hashes] == [hashlib.sha256(b"abc").hexdigest()]
    assert files.newest_file(spark, str(tmp_path), "other*").endswith("other.csv")
    assert files.newest_file(spark, str(tmp_path), "*", explicit="x") == "x"
    with pytest.raises(FileNotFoundError):
        files.newest_file(spark, str(tmp_path), "*.parquet")


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,a\n1,?\n2,"x, y"\n3,None\n')
    path = str(tmp_path / "in.csv")
    assert [r.a for r in files.read_csv_text(spark, path).collect()] == ["?", "x, y", "None"]
    assert dict(files.read_csv_inferred(spark, path).dtypes)["id"] == "int"
    typed = files.read_csv_null_tokens(spark, path, ("?", "None"), {"id": "bigint"})
    assert [(r.id, r.a) for r in typed.collect()] == [(1, None), (2, "x, y"), (3, None)]
    assert files.with_row_id(typed).select("row_id").distinct().count() == 3
    layer = str(tmp_path / "layer")
    files.write_layer(typed, layer)
    assert files.count_in_file(spark, layer, "id").first().asDict() == {"row_count": 3, "distinct_count": 3}
    assert files.query(spark, "SELECT :n AS n", n=4).first().n == 4
    files.write_csv_report(typed, str(tmp_path / "report"))
    files.write_json_report(files.json_document(typed.agg(F.count("*").alias("n")), rows=typed), str(tmp_path / "json"))
    assert '"summary":{"n":3}' in spark.read.text(str(tmp_path / "json")).first().value


def test_tables(spark, tmp_path):
    name = f"stayloom_test_{tmp_path.name.replace('-', '_')}"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert files.replace_table(df, name, path=str(tmp_path / "t")) == 2
    with pytest.raises(ValueError, match="nothing to store"):
        files.replace_table(df.filter("false"), name + "_e", path=str(tmp_path / "e"))
    files.insert_absent(spark.createDataFrame([(2, "z"), (3, "c")], "id int, v string"), name, "id")
    assert {(r.id, r.v) for r in spark.table(name).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    files.truncate_insert(df.select("v", "id"), name)
    assert {(r.id, r.v) for r in spark.table(name).collect()} == {(1, "a"), (2, "b")}
    spark.sql(f"DROP TABLE {name}")


def test_a_failing_replacement_leaves_the_old_table(spark, tmp_path):
    name, path = f"stayloom_versions_{tmp_path.name.replace('-', '_')}", str(tmp_path / "t")
    files.replace_table(spark.range(5), name, path)
    broken = spark.range(3).select(F.assert_true(F.col("id") < 2).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        files.replace_table(broken, name, path)
    assert spark.table(name).count() == 5
    files.replace_table(spark.table(name).filter("id > 1"), name, path)  # reads what it replaces
    assert {r.id for r in spark.table(name).collect()} == {2, 3, 4}
    files.replace_table(spark.range(2).selectExpr("id", "'x' AS v"), name, path)  # another schema
    assert [tuple(r) for r in spark.table(name).orderBy("id").collect()] == [(0, "x"), (1, "x")]
    files.truncate_insert(spark.table(name).limit(0), name, path)
    assert spark.table(name).isEmpty() and spark.table(name).columns == ["id", "v"]
    spark.sql(f"DROP TABLE {name}")


def test_types_come_from_the_head_and_later_misfits_are_errors(spark, tmp_path):
    rows = [f"{i},{i}.5,{i + 2**40},2020-01-02,true,a{i}, {i},1d,NaN," for i in range(20)]
    (tmp_path / "t.csv").write_text("\n".join(["a,b,c,d,e,f,g,h,i,j", *rows]) + "\n")
    got = files.read_csv_inferred(spark, str(tmp_path / "t.csv"), head=10)
    assert [t for _, t in got.dtypes] == ["int", "double", "bigint", "timestamp", "boolean", *["string"] * 5]
    assert got.agg(F.sum("a")).first()[0] == 190
    (tmp_path / "m.csv").write_text("\n".join(["a", *map(str, range(10_000)), "late"]) + "\n")
    late = files.read_csv_inferred(spark, str(tmp_path / "m.csv"))
    assert late.dtypes == [("a", "int")]
    with pytest.raises(Exception, match="MALFORMED"):
        late.collect()
    (tmp_path / "e.csv").write_text("a,b\n")
    assert files.read_csv_inferred(spark, str(tmp_path / "e.csv")).dtypes == [("a", "string"), ("b", "string")]


def test_files_are_hashed_in_pieces(spark, tmp_path):
    whole = bytes(range(256)) * (3 * files.CHUNK_BYTES // 256) + b"end"
    (tmp_path / "large one.bin").write_bytes(whole)
    (tmp_path / "none.bin").write_bytes(b"")
    got = {r.length: r.sha256 for r in files.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {len(whole): hashlib.sha256(whole).hexdigest()}  # Spark does not list empty files
    batch = next(files._hash_files(iter([pd.DataFrame({"path": [str(tmp_path / "none.bin")], "length": [0]})])))
    assert batch.sha256[0] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("texts", [
    ["1996-01-02", "1996-01-03 08:30:00", "01/02/1996", "1996-1-4", " 1996-01-05"],
    [None, "", "1996-01-02 08:30:00", "1996-01-03", "1996-01-04 09:00:00"],
    ["01/02/1996", "1996-01-02", "13/02/1996", "1/3/1996"],
    ["25/02/1996", "01/02/1996", "02/25/1996"],
    ["19960102", "1996-01-02", "19960103"],
    ["n/a", "1996-01-02", "1996-01-03 08:30:00", "01/02/1996"],  # elects nothing: each for itself
    ["", None], ["NaT", "1996/01/02", "1996-01-02"],
])
def test_the_first_date_elects_the_format(spark, texts):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [None if pd.isna(x) else x.date() for x in pd.to_datetime(pd.Series(texts, dtype=object), errors="coerce")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, d string").repartition(3)
    rows = df.withColumn("elected", legacy.elected_formats(df, ["d"], F.col("n")))
    got = rows.select("n", legacy.lenient_date("d", F.col("elected")["d"]).alias("d")).orderBy("n").collect()
    assert [r.d for r in got] == want


def test_legacy(spark):
    df = spark.createDataFrame([
        ("2020-01-01", "2020-01-04", "40", " OUI ", "h", "oui", None),
        ("n/a", "2020-01-04", "40", "non", "F", "non", "3"),
        ("2020-01-01", "2020-01-02", "x", "non", "F", "non", "3")],
        " Date_Entree string, date_sortie string, AGE string, diabete string, sexe string, rehospitalise_30j string, "
        "delai_depuis_derniere_hosp_jours string".replace(" Date_Entree", "`Date_Entree`"))
    rows = legacy.legacy_clean(df).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.duree_sejour, row.age, row.diabete, row.sexe, row.delai_depuis_derniere_hosp_jours) == (3, 40, 1, 1, 999)


def test_stored_trees_give_the_scores_and_the_gradient_is_zero(spark, layers, tmp_path):
    train, test = layers.train_and_test()
    folder = str(tmp_path)
    ml.train_and_store(train, test, folder, forest_trees=3, boosting_rounds=3)
    for name in ("random_forest", "boosted_trees"):
        own = ml.score(ml.load_model(folder, name), test).select("encounter_id", F.col("score").alias("own"))
        both = ml.rescore(folder, name, test).join(own, "encounter_id")
        row = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("score") - F.col("own"))).alias("d")).first()
        assert row.n == test.count() and row.d < 1e-12
        leaves, nodes = (spark.read.parquet(f"{folder}/trees/{name}/{t}") for t in ("leaves", "nodes"))
        assert leaves.count() == nodes.filter("feature < 0").count()
        # every row lies in exactly one leaf of a tree, and it is the leaf with the value that was scored
        vectors = ml.PipelineModel(stages=ml.load_model(folder, name).stages[:-1]).transform(test).select(
            "encounter_id", trees.vector_to_array("features").alias("x")).limit(40)
        inside = F.forall("path", lambda p: F.coalesce(F.get("x", p["feature"]) > p["above"], F.lit(True)) & F.coalesce(
            F.get("x", p["feature"]) <= p["upto"], F.lit(True)))
        met = vectors.join(F.broadcast(leaves), inside).groupBy("encounter_id").agg(
            F.count("*").alias("n"), F.countDistinct("tree").alias("t"),
            F.sum(F.col("weight") * F.col("value")).alias("total"), F.sum("weight").alias("weight"))
        chance = F.col("total") / F.col("weight") if name == "random_forest" else 1 / (1 + F.exp(-2 * F.col("total")))
        checked = met.join(own, "encounter_id").select("n", "t", F.abs(chance - F.col("own")).alias("d")).collect()
        assert len(checked) == 40 and all((r.n, r.t) == (3, 3) and r.d < 1e-12 for r in checked)
    model = ml.load_model(folder, "logistic_regression")
    vectors = ml.PipelineModel(stages=model.stages[:-1]).transform(ml.weighted(train))
    slopes = trees.logistic_gradient(vectors, model.stages[-1], ml.MODEL_TARGET, "class_weight")
    row = slopes.agg(F.count("*").alias("n"), F.max(F.abs("gradient")).alias("g")).first()
    assert row.n == model.stages[-1].numFeatures + 1 and row.g < 1e-4
