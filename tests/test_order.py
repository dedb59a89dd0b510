import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayloom.operators import order, profile, selection
from stayloom.operators import trend as trend_module


@pytest.fixture(scope="module")
def numbers(spark):
    generator = random.Random(5)
    rows = [(i, "hot" if i % 3 else generator.choice("abc"), 7 if i % 3 == 0 else generator.randrange(50))
            for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id int, g string, v int").repartition(7)


def test_dense_key(numbers):
    rows, df = numbers
    got = order.dense_key(df.withColumn("k", F.md5(F.col("id").cast("string"))), ["k"], "key").select("key", "k").collect()
    assert [r.k for r in sorted(got)] == sorted(r.k for r in got)
    assert sorted(r.key for r in got) == list(range(1, len(rows) + 1))


def test_running_total(numbers):
    rows, df = numbers
    got = {r.id: r.t for r in order.running_total(df, ["id"], {"t": "v"}, ["g"]).collect()}
    sums, want = {}, {}
    for i, g, v in rows:
        want[i] = sums[g] = sums.get(g, 0) + v
    assert got == want


def test_carry_forward(spark, numbers):
    rows, _ = numbers
    marked = [(i, g, v if v == 7 else None) for i, g, v in rows]
    df = spark.createDataFrame(marked, "id int, g string, m int").repartition(5)
    got = {r.id: r.m for r in order.carry_forward(df, ["id"], "m", ["g"]).collect()}
    last, want = {}, {}
    for i, g, m in marked:
        last[g] = want[i] = last.get(g) if m is None else m
    assert got == want


def test_quantiles(numbers):
    rows, df = numbers
    wanted = {"q80": 0.8, "q95": 0.95, "q0": 0.0, "q1": 1.0}
    exact = df.groupBy("g").agg(*(F.percentile("v", q).alias(n) for n, q in wanted.items())).collect()
    got = order.quantiles(df, "v", wanted, ["g"]).collect()
    assert {r.g: pytest.approx([r[n] for n in wanted]) for r in exact} == {r.g: [r[n] for n in wanted] for r in got}
    values = sorted(v for _, _, v in rows)
    near = order.quantiles(df, "v", {"q": 0.25}, method="nearest").first().q
    assert near == values[int((len(values) - 1) * 0.25 + 0.5)]


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0,
           1.0000000000000002, 0.9999999999999999, -1.0, 8.0, 7.999999999999999, 0.1, 1e300, float("inf"), -float("inf")]


def test_codes_keep_order_and_value(spark):
    df = spark.createDataFrame([(x,) for x in AWKWARD] + [(None,), (float("nan"),)], "x double")
    rows = df.select("x", selection.ordered_code(F.col("x"), df.schema["x"].dataType).alias("c")).collect()
    assert all(r.c is None if r.x is None else selection.value_of(r.c, df.schema["x"].dataType) == r.x or r.x != r.x
               for r in rows)
    known = [r for r in rows if r.x is not None and r.x == r.x]
    assert all((a.x < b.x) == (a.c < b.c) for a in known for b in known)
    assert next(r.c for r in rows if r.x != r.x and r.x is not None) > max(r.c for r in known)


@pytest.mark.parametrize("digit", [2, 12])
def test_selected_quantiles(spark, monkeypatch, digit):
    monkeypatch.setattr(selection, "DIGIT", digit)
    monkeypatch.setattr(selection, "WIDTH", 1 << digit)
    rng = random.Random(4)
    rows = [(rng.gauss(0, 1e9), rng.choice([-2**63, 2**63 - 1, 0, 7, 7, 7]), Decimal(rng.randrange(-9999, 9999)) / 100,
             1.5, None) for _ in range(500)] + [(None, None, None, 1.5, None)] * 20
    df = spark.createDataFrame(rows, "a double, b long, `c d` decimal(10,2), same double, none int")
    wanted = {"q0": 0.0, "q25": 0.25, "q80": 0.8, "q1": 1.0}
    got = selection.select_quantiles(df, df.columns, wanted)
    for k, c in enumerate(df.columns):
        values = sorted(float(r[k]) for r in rows if r[k] is not None)
        for name, q in wanted.items():
            if not values:
                assert got[c][name] is None
                continue
            at = (len(values) - 1) * q
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got[c][name] == pytest.approx(low + (high - low) * (at - math.floor(at)), rel=1e-12), (c, name)
    assert selection.select_quantiles(df.limit(0), ["a"], wanted)["a"] == dict.fromkeys(wanted)


def test_selection_neither_sorts_values_nor_writes(spark):
    df = spark.range(100000).selectExpr("id * 7919 % 100003 AS x")
    assert selection.select_quantiles(df, ["x"], {"m": 0.5}, "nearest")["x"]["m"] == sorted(
        k * 7919 % 100003 for k in range(100000))[50000]
    plan = profile.describe(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_duplicate_rows_by_digest(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, "a"), (1, "a"), (2, "a")], "x int, y string")
    out = profile.duplicate_row_count(df)
    assert out.first()[0] == 3 and profile.duplicate_row_count(df.limit(0)).first()[0] == 0
    assert profile.duplicate_row_count(df.filter("x = 2")).first()[0] == 0


def test_keep_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, "b")], "row_id int, k string")
    assert {r.row_id for r in order.keep_first(df, "k").collect()} == {1, 2, 4}


def test_keep_first_hot_key(spark):
    df = spark.range(3000).selectExpr("id AS row_id", "if(id % 3 = 0, -1, id) AS k")
    kept = order.keep_first(df, "k")
    assert kept.count() == 2001 and kept.filter("k = -1").first().row_id == 0


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 9, "x"), (1, 2, "y"), (2, 5, None)], "p int, e int, v string")
    assert {(r.p, r.v) for r in order.first_per_key(df, "p", "e", ["v"]).collect()} == {(1, "y"), (2, None)}


def test_trend_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(trend_module, "_BLOCK", 4)
    df = spark.range(23).selectExpr("id", "id * id AS v")
    got = {r.id: (r.previous_v, r.v_change) for r in trend_module.trend(df, ["id"], "v").collect()}
    assert got == {i: (None, None) if i == 0 else ((i - 1) ** 2, i * i - (i - 1) ** 2) for i in range(23)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "x int")
    assert [r["count"] for r in profile.histogram(df, "x", 4).orderBy("bin").collect()] == [1, 2, 0, 1]
    same = profile.histogram(spark.createDataFrame([(3,), (3,)], "x int"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == [0, 0, 2, 0] and same[0].lower == 2.5


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (None,)], "x int")
    row = profile.describe(df).first()
    assert (row["count"], row.null_count, row.min, row.q50, row.max) == (3, 1, 1.0, 2.0, 4.0)
    assert row["mean"] == pytest.approx(7 / 3) and row["std"] == pytest.approx(1.5275252)


def test_distinct_counts_null_is_a_value(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "x string, y string")
    assert {r.column_name: r.unique_count for r in profile.distinct_counts(df).collect()} == {"x": 3, "y": 1}
    assert [r.column_name for r in profile.constant_columns(df).collect()] == ["y"]


def test_severity(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (20.0,), (50.0,)], "p double")
    assert [r.s for r in df.select(profile.severity("p").alias("s")).collect()] == [
        "Aucune valeur manquante", "Faible", "Modéré", "Élevé", "Critique"]


def test_plans_have_no_cross_or_single_partition_window(layers):
    from stayloom.catalog import QUERIES

    for name in ("dq_violations", "dq_valid_rows", "mart_patients", "kpi_global", "patients_page", "feature_table"):
        plan = QUERIES[name](layers)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_fact_join_needs_no_shuffle(spark, layers):
    from stayloom.plans.marts import encounter_outcomes

    layers.fact_hospitalization(), layers.fact_readmission()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = encounter_outcomes(layers)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_pushdown_and_pruning(layers):
    plan = layers.curated().filter("time_in_hospital > 12").groupBy("gender").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time_in_hospital,12)" in text and "ReadSchema: struct<gender:string,time_in_hospital:bigint>" in text
