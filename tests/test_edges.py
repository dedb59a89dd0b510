"""Values at the edge of what the readers, rules and ledgers accept."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from stayloom.functions.text import strict_integer
from stayloom.operators import ledger
from stayloom.plans import legacy, ml
from stayloom.sources import files, reference_data


def test_integer_ends_with_the_text(spark):
    rows = spark.createDataFrame([("4",), ("4\n",), ("+4",), ("4 ",), ("",), ("9" * 30,)], "x string")
    assert [r[0] for r in rows.select(strict_integer("x")).collect()] == [4, None, 4, None, None, None]


def test_legacy_numbers_dates_and_codes(spark):
    rows = [("12", "2020-01-02", "\toui\n", " h"), ("1d", "2020-01-02 08:30:00", "OUI", "F\t"), ("1e2", "2020/01/02", "x", "?"),
            (" .5 ", "2020-01-02T08:30", "non", None), ("1f", "01/02/2020", None, "H"), ("0x1", "soon", "Non", "f")]
    df = spark.createDataFrame(rows, "n string, d string, y string, s string")
    got = df.select(legacy.lenient_number("n"), legacy.lenient_date("d").cast("string"), legacy.yes_no("y"),
                    legacy.sex_code("s")).collect()
    assert [r[0] for r in got] == [12.0, None, 100.0, 0.5, None, None]
    assert [r[1] for r in got] == ["2020-01-02"] * 5 + [None]
    assert [r[2] for r in got] == [1, 1, None, 0, None, 0]
    assert [r[3] for r in got] == [1, 0, None, None, 1, 0]


def test_details_of_all_events_are_kept(spark):
    events = spark.sql("""SELECT * FROM VALUES
        (1, 'RUNNING', TIMESTAMP '2024-01-01 00:00:00', map('table', 't', 'n', '0')),
        (1, 'SUCCESS', TIMESTAMP '2024-01-01 00:00:00', map('n', '5')),
        (2, 'RUNNING', TIMESTAMP '2024-01-01 00:00:00', map('table', 'u')) AS e(run_id, status, at, details)""")
    got = {r.run_id: (r.status, r.details) for r in ledger.current_state(events).collect()}
    assert got == {1: ("SUCCESS", {"table": "t", "n": "5"}), 2: ("RUNNING", {"table": "u"})}


def test_equal_files_of_a_batch_are_imported_once(spark):
    new = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id long, sha256 string")
    history = spark.createDataFrame([(9, "b", "SUCCESS"), (8, "c", "FAILED")], "id long, sha256 string, status string")
    assert {r.id for r in ledger.to_import(new, history).collect()} == {1, 4}


def test_an_empty_frame_does_not_replace_a_table(spark, tmp_path):
    df = spark.range(3)
    name = "stayloom_kept_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert files.replace_table(df, name, path=str(tmp_path / "kept")) == 3
    with pytest.raises(ValueError):
        files.replace_table(df.limit(0), name, path=str(tmp_path / "kept"))
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_csv_with_a_byte_order_mark(spark, tmp_path):
    files.write_csv(spark.range(2).coalesce(1), str(tmp_path / "marked"), byte_order_mark=True)
    (part,) = (tmp_path / "marked").glob("part-*")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid\n")


def test_an_unseen_category_is_all_zeros(spark, layers):
    rows = layers.model_split().drop("is_test")
    stages = Pipeline(stages=ml.preprocessing(rows)).fit(rows)
    unseen = stages.transform(rows.limit(1).withColumn("race", F.lit("never seen"))).first()
    assert unseen.race_v.numNonzeros() == 0 and unseen.gender_v.numNonzeros() <= 1


def test_requests_are_checked_in_every_field(spark):
    good = {**{c: "1" for c in ml.REQUEST_FIELDS}, "row_id": 1}
    bad = {**good, "row_id": 2, "gender": None, "age_midpoint": "101", "admission_type_id": "x", "num_procedures": "1.5"}
    rows = spark.createDataFrame([good, bad], ", ".join(f"{c} string" for c in ml.REQUEST_FIELDS) + ", row_id long")
    got = {(r.row_id, r.column_name, r.rule_name) for r in ml.request_violations(rows).collect()}
    assert len(ml.REQUEST_FIELDS) == 22
    assert got == {(2, "gender", "required_value"), (2, "age_midpoint", "invalid_numeric_value"),
                   (2, "admission_type_id", "invalid_numeric_value"), (2, "num_procedures", "invalid_numeric_value")}


def test_code_dimensions_are_sized_relations(spark):
    counts = {}
    for name, df in reference_data.code_dimensions(spark).items():
        codes = [r[0] for r in df.collect()]
        assert sorted(codes) == sorted(set(codes)) and all(r[1] == r[1].strip() for r in df.collect() if r[1])
        counts[name] = len(codes)
        assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert counts == {"dim_admission_type": 8, "dim_discharge_disposition": 30, "dim_admission_source": 25}
