"""Joins of tables that grow with the data must not depend on how small their files look."""

from types import SimpleNamespace

import pytest

from stayloom.operators import order, quality
from stayloom.plans import marts, measures, warehouse
from stayloom.plans.layers import Layers
from stayloom.schema import HOSPITAL_RULES, RuleSet


@pytest.fixture(scope="module")
def star(spark):
    def table(rows, columns):
        df = spark.createDataFrame(rows, columns)
        return lambda: df

    stays = [(k, k % 3 + 1, k % 2 + 1, 1, 1, 1, 1, 1, 1, *[k] * 8) for k in range(6)] + [(5, 1, None, 1, 1, 1, 1, 1, 1, *[7] * 8)]
    kinds = "gender string, race string, first_age_bracket string"
    return SimpleNamespace(
        fact_hospitalization=table(stays, (
            "encounter_key long, patient_key long, diag_1_key long, diag_2_key long, diag_3_key long, admission_type_id int, "
            "discharge_disposition_id int, admission_source_id int, unused int, time_in_hospital int, "
            "num_lab_procedures int, num_procedures int, num_medications int, number_diagnoses int, "
            "total_previous_visits int, healthcare_utilization_score int, patient_complexity_score int")),
        fact_readmission=table([(k, "NO", k % 2, 1, 0, 1, 0) for k in range(6)], (
            "encounter_key long, readmitted string, readmitted_30_days int, readmitted_flag int, is_frequent_patient int, "
            "insulin_prescribed int, high_medication_burden_flag int")),
        fact_medication_usage=table([(1, 1, 1, "Up", 1), (2, 2, 1, "No", 0)], (
            "fact_medication_usage_id long, encounter_key long, medication_key int, status string, dosage_changed int")),
        dim_patient=table([(k, k * 10, "Male", "Other", "[0-10)", 5) for k in (1, 2, 3)], (
            f"patient_key long, patient_nbr long, {kinds}, first_age_midpoint int")),
        dim_diagnosis=table([(1, "250", "Diabetes"), (2, "428", "Circulatory")], (
            "diagnosis_key long, diagnosis_code string, diagnosis_group string")),
        dim_medication=table([(1, "insulin")], "medication_key int, medication_name string"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_and_measures_merge_the_facts_and_the_patients(star):
    for df in (marts.encounter_outcomes(star), marts.mart_patients(star), measures.global_kpis(star),
               measures.patient_factor_rates(star, ("gender",)), measures.patients_by_group(star, ("gender",))):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    for df in (marts.mart_diagnostics(star), marts.mart_medications(star), measures.patient_detail(star, 20)):
        assert "SortMergeJoin" in plan(df)  # what is broadcast are codes, drugs or one patient


def test_the_rows_are_those_of_the_facts(star):
    assert marts.encounter_outcomes(star).count() == 7
    patients = {r["patient_key"]: (r["total_encounters"], r["readmitted_30_days_count"])
                for r in marts.mart_patients(star).collect()}
    assert patients == {1: (3, 2), 2: (2, 1), 3: (2, 1)}
    assert [r["total_encounters"] for r in measures.patient_detail(star, 20).collect()] == [2]


def test_foreign_keys_and_absent_keys_merge(star):
    bridge, stays = star.fact_medication_usage(), star.fact_hospitalization()
    orphans = quality.foreign_keys(bridge, "encounter_key", stays, "encounter_key", "fk")
    assert "Broadcast" not in plan(orphans) and orphans.first()["failed_rows"] == 0
    new = star.dim_patient()
    absent = warehouse.absent_only(new, star.dim_patient().filter("patient_key > 1"), "patient_nbr")
    assert "Broadcast" not in plan(absent) and [r["patient_key"] for r in absent.collect()] == [1]


def test_rows_are_not_shuffled_to_find_repeated_ones(spark):
    rules = RuleSet(columns=("a", "b"), bounds={}, allowed={})
    rows = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "z"), (4, "y", "w"), (5, None, None), (6, None, None),
                                  (7, None, "v")], "row_id long, a string, b string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are large by their files
    try:
        found = quality.row_duplicates(rows, rules)
        assert "BroadcastHashJoin [coalesce(_probe" in plan(found)
        assert sorted(r["row_id"] for r in found.collect()) == [1, 2, 5, 6]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_many_repeated_keys_are_merged(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_KEYS", 0)
    rules = RuleSet(columns=("a", "b"), bounds={}, allowed={})
    rows = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "z")], "row_id long, a string, b string")
    found = quality.row_duplicates(rows, rules)
    assert "SortMergeJoin" in plan(found) and sorted(r["row_id"] for r in found.collect()) == [1, 2]


def test_raw_rows_are_dealt_before_they_are_wide(spark, tmp_path, monkeypatch):
    orders = spark.createDataFrame([(k, k % 7) for k in range(1000)] + [(1, 1), (None, 3)], "o_orderkey long, o_custkey long")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    star = Layers(spark, str(tmp_path), buckets=3)
    assert star.raw().exceptAll(star.raw_lazy()).count() == 0 and star.raw().count() == star.raw_lazy().count()
    monkeypatch.setattr(star, "_layer", lambda name, build, bucket=None: build())
    assert "Exchange hashpartitioning(o_orderkey" in plan(star.raw()) and "hashpartitioning(row_id" not in plan(star.raw())
    assert star.raw().rdd.getNumPartitions() == 3


def test_rows_stay_where_they_are_beside_few_repeated_keys(spark, raw):
    rows = raw({"encounter_id": "1"}, {"encounter_id": "2"}, {"encounter_id": "2"}, {"encounter_id": None}, {"encounter_id": None})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are large by their files
    try:
        for found, ids in ((quality.valid_rows(rows, HOSPITAL_RULES), [0]), (order.keep_first(rows, "encounter_id"), [0, 1, 3]),
                           (quality.key_duplicates(rows, HOSPITAL_RULES, ("race",)), [1, 2])):
            assert "Exchange hashpartitioning" not in plan(found) and "SortMergeJoin" not in plan(found)
            assert sorted(r["row_id"] for r in found.collect()) == ids
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_are_merged_with_many_repeated_keys(raw, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(order, "BROADCAST_KEYS", 0)
    rows = raw({"encounter_id": "1"}, {"encounter_id": "2"}, {"encounter_id": "2"}, {"encounter_id": None}, {"encounter_id": None})
    for found, ids in ((quality.valid_rows(rows, HOSPITAL_RULES), [0]), (order.keep_first(rows, "encounter_id"), [0, 1, 3]),
                       (quality.key_duplicates(rows, HOSPITAL_RULES, ("race",)), [1, 2])):
        assert "SortMergeJoin" in plan(found) and sorted(r["row_id"] for r in found.collect()) == ids
