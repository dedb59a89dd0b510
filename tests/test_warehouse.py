import pytest

from stayloom.operators import ledger, quality
from stayloom.plans import chain, marts, measures, warehouse
from stayloom.schema import MEDICATIONS
from stayloom.sources import reference_data


def test_reference_sections(spark):
    first, second, third = reference_data.REFERENCE_SECTIONS
    lines = [f"{first},description", "1,By appointment", "2,", ",", f"{second},description", '4,"Left, against advice"', ",",
             f"{third},description", "9, By letter"]
    parsed = reference_data.parse_stacked(spark.createDataFrame(
        [("codes", n, line) for n, line in enumerate(lines, start=1)], "file string, line_no int, line string"))
    dims = reference_data.reference_dimensions(parsed)
    got = {k: {r[0]: r[1] for r in v.collect()} for k, v in dims.items()}
    assert {k: sorted(v) for k, v in got.items()} == {
        "dim_admission_type": [1, 2], "dim_discharge_disposition": [4], "dim_admission_source": [9]}
    assert got["dim_discharge_disposition"][4] == "Left, against advice"
    assert got["dim_admission_source"][9].strip() == "By letter" and got["dim_admission_type"][1] == "By appointment"


def test_stacked_file_rules(spark, tmp_path):
    (tmp_path / "codes.csv").write_text(
        "﻿admission_type_id,description\n1,\nx,no\n2, b \n,\n3,outside\nadmission_source_id,d\n4,c\n")
    rows = reference_data.parse_stacked(reference_data.read_stacked(spark, str(tmp_path))).collect()
    assert {(r.section, r.id, r.description) for r in rows} == {
        ("admission_type_id", 1, "Non disponible"), ("admission_type_id", 2, "b"), ("admission_source_id", 4, "c")}


def test_calendar(spark):
    days = warehouse.dim_date(spark)
    assert days.count() == 3653
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.month_name, first.day_name, first.day_of_week_number, first.is_weekend) == (
        19990101, "January", "Friday", 5, False)
    new = warehouse.absent_only(days, days.filter("year_number < 2008"), "date_key")
    assert new.count() == 366


def test_drugs(spark):
    assert sorted(r.medication_name for r in warehouse.dim_medication(spark).collect()) == sorted(MEDICATIONS)


def test_grains_and_keys(layers):
    assert marts.mart_hospitalizations(layers).count() == layers.fact_hospitalization().count()
    assert marts.mart_readmission(layers).count() == layers.fact_readmission().count()
    assert marts.mart_patients(layers).count() == layers.dim_patient().count()
    assert marts.mart_diagnostics(layers).filter("readmitted_30_days_rate NOT BETWEEN 0 AND 1").isEmpty()
    for df, key in ((layers.dim_patient(), "patient_key"), (layers.fact_medication_usage(), "fact_medication_usage_id")):
        quality.raise_on_failure(quality.unique_key(df, key))


def test_kpis_on_an_empty_warehouse(layers):
    class Empty:
        def fact_hospitalization(self):
            return layers.fact_hospitalization().filter("false")

        def fact_readmission(self):
            return layers.fact_readmission().filter("false")

    row = measures.global_kpis(Empty()).first()
    assert set(row) == {0, 0.0}


def test_listing(spark):
    df = spark.range(10).selectExpr("id", "if(id % 2 = 0, 'F', 'M') AS gender")
    rows = measures.page(measures.where_equal(df, gender="F", race=None), "id", limit=2, offset=1).collect()
    assert [(r.id, r.total) for r in rows] == [(2, 5), (4, 5)]


def test_row_security(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, medical_specialty string")
    grants = spark.createDataFrame([("u", "A"), ("u", "B"), ("w", "B"), ("u", "A")], "principal string, specialty string")
    assert [r.id for r in measures.restricted_to(df, "A").collect()] == [1]
    assert {r.id for r in measures.restricted_to(df, "u", grants).collect()} == {1, 2}


def test_whole_chain(spark, raw, tmp_path):
    rows = raw(*({"encounter_id": str(i), "patient_nbr": str(i % 5 + 1)} for i in range(1, 21)), {"age": "bad", "encounter_id": "99"})
    reference = reference_data.code_dimensions(spark)
    out = str(tmp_path)
    assert set(chain.run_chain(spark, rows, out, reference, content_hash="h").values()) == {"SUCCESS"}
    assert spark.read.parquet(f"{out}/clean").count() == 20 and spark.read.parquet(f"{out}/quarantine").count() == 1
    assert spark.table("mart_patients").count() == 5
    assert set(chain.run_chain(spark, rows, out, reference, content_hash="h").values()) == {"SKIPPED"}
    try:
        chain.run_chain(spark, rows.drop("age"), out, reference)
        raise AssertionError("a missing column must stop the chain")
    except ValueError:
        pass
    states = sorted(r.status for r in chain.run_history(spark, out).collect())
    assert states == ["FAILED", "SUCCESS"]


class Killed(BaseException):
    """What a driver that is killed looks like to the run: nothing catches it."""


def test_a_killed_chain_resumes_at_the_first_unfinished_step(spark, raw, tmp_path, monkeypatch):
    rows = raw(*({"encounter_id": str(i), "patient_nbr": str(i % 5 + 1)} for i in range(1, 21)),
               {"age": "bad", "encounter_id": "99"})
    reference, out = reference_data.code_dimensions(spark), str(tmp_path)

    def killed(_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(chain.features, "features", killed)
        with pytest.raises(Killed):
            chain.run_chain(spark, rows, out, reference, buckets=2)
    (first,) = chain.run_history(spark, out).collect()
    assert first.status == "RUNNING"
    assert [r.status for r in chain.chain_status(spark, out).orderBy("position").collect()] == ["SUCCESS"] * 3 + ["PENDING"] * 3
    (before,) = chain.quality_history(spark, out).collect()

    status = chain.run_chain(spark, rows, out, reference, buckets=2)
    assert [status[s] for s in chain.STEPS] == ["REUSED"] * 3 + ["SUCCESS"] * 3
    (run,) = chain.run_history(spark, out).collect()
    assert (run.run_id, run.status) == (first.run_id, "SUCCESS")
    assert chain.quality_history(spark, out).collect() == [before]  # told once
    assert (before.total_rows, before.valid_rows, before.total_violations) == (21, 20, 1)
    assert [(r.rule_name, r.violation_count) for r in chain.rule_history(spark, out).collect()] == [("invalid_category", 1)]
    assert {r.rows for r in chain.chain_status(spark, out).collect()} == {20, 21}

    star = chain.StoredStar(spark, out, reference)
    joined = star.fact_hospitalization().join(star.fact_readmission(), "encounter_key")
    with_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast)
    assert "Exchange" not in plan

    # a run that fails is closed and stays; the step it stopped at is told
    with pytest.raises(ValueError):
        chain.run_chain(spark, rows.drop("age"), out, reference, buckets=2)
    assert sorted(r.status for r in chain.run_history(spark, out).collect()) == ["FAILED", "SUCCESS"]
    assert [r.status for r in chain.chain_status(spark, out).orderBy("position").collect()] == ["FAILED"] + ["PENDING"] * 5
    assert {r.status for r in chain.import_history(spark, out).collect()} == {"FAILED", "SUCCESS"}


def test_an_event_told_again_replaces_itself(spark, tmp_path):
    store = ledger.EventStore(spark, str(tmp_path))
    assert store.events("etl").isEmpty()
    for n in (1, 2):
        store.tell("etl", "12e4", "opened", "RUNNING", {"rows": n, "note": None})  # an id that looks like a number
    store.tell("etl", "7", "opened", "RUNNING", {"rows": 5})
    store.tell("etl", "7", "closed", "SUCCESS", spark.range(1).selectExpr("6 AS rows", "CAST(NULL AS STRING) AS note"))
    got = store.runs("etl", {"rows": "bigint", "note": "string"}).collect()
    assert {(r.run_id, r.status, r.rows, r.note) for r in got} == {("12e4", "RUNNING", 2, None), ("7", "SUCCESS", 6, None)}


def test_a_fingerprint_of_rows_counts_copies_and_ignores_order(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    other = spark.createDataFrame([(2, None), (1, "a"), (1, "a")], "id int, v string").repartition(3)
    assert chain.rows_fingerprint(one) == chain.rows_fingerprint(other)
    assert chain.rows_fingerprint(one) != chain.rows_fingerprint(one.distinct())
    assert chain.rows_fingerprint(one.limit(0)) != chain.rows_fingerprint(one)
