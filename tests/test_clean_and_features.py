import pytest
from pyspark.sql import functions as F

from stayloom.operators import quality
from stayloom.plans import clean, features
from stayloom.schema import ENCOUNTER_COLUMNS, FEATURE_COLUMNS, FLAG_COLUMNS, SOURCE_NAMES


def test_clean_step(raw):
    rows = raw({"diag_1": " v45 ", "diag_2": "?", "race": "", "insulin": " Up "}).withColumnsRenamed(SOURCE_NAMES)
    out = clean.curated(rows, "file.csv", "2024-01-01 00:00:00")
    assert out.columns == [*ENCOUNTER_COLUMNS, *clean.AUDIT_COLUMNS] and len(out.columns) == 53
    row = out.first()
    assert (row.diag_1, row.diag_2, row.race, row.weight, row.insulin) == ("V45", None, "Unknown", "Unknown", "Up")
    assert (row.encounter_id, row.a1c_result, row.etl_source_file) == (1, "None", "file.csv")
    assert dict(out.dtypes)["time_in_hospital"] == "bigint"
    quality.raise_on_failure(quality.curated_checks(out, "encounter_id", clean.INTEGER_COLUMNS))


def test_keep_first_and_statistics(raw):
    rows = raw({"patient_nbr": "1"}, {"patient_nbr": "2"}, {"encounter_id": " 1 ", "patient_nbr": "3"},
               {"encounter_id": "2"}, {"encounter_id": "2"})
    out = clean.curated(rows)
    assert {(r.encounter_id, r.patient_nbr) for r in out.collect()} == {(1, 1), (2, 100)}
    stats = clean.clean_statistics(rows, out).first()
    assert (stats.input_rows, stats.output_rows, stats.duplicates_removed, stats.output_columns) == (5, 2, 3, 53)


def test_strict_cast_raises(raw):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.curated(raw({"num_procedures": "4.5"})).collect()


def one(raw, **values):
    return features.features(clean.curated(raw(values))).first()


def test_features(raw):
    row = one(raw, readmitted="<30", age="[70-80)", number_outpatient="1", number_emergency="1", number_inpatient="1",
              insulin="Up", metformin="Steady", num_medications="15", diag_1="250.83", diag_2="785.4", diag_3="V45")
    assert (row.readmitted_30_days, row.readmitted_flag, row.age_midpoint) == (1, 1, 75)
    assert (row.total_previous_visits, row.healthcare_utilization_score, row.is_frequent_patient) == (3, 6, 1)
    assert (row.active_medications_count, row.medication_dosage_changes_count, row.insulin_prescribed) == (2, 1, 1)
    assert row.high_medication_burden_flag == 1
    assert (row.diag_1_group, row.diag_2_group, row.diag_3_group) == ("Diabetes", "Circulatory", "Other")
    assert row.patient_complexity_score == 15 + 1 + 5 + 3


@pytest.mark.parametrize("code, family", [
    ("250", "Diabetes"), ("2509", "Diabetes"), ("389", "Other"), ("390", "Circulatory"), ("459.9", "Circulatory"),
    ("460", "Respiratory"), ("519", "Respiratory"), ("786", "Respiratory"), ("520", "Digestive"), ("787", "Digestive"),
    ("580", "Genitourinary"), ("788", "Genitourinary"), ("710", "Musculoskeletal"), ("740", "Other"),
    ("800", "Injury"), ("999", "Injury"), ("140", "Neoplasms"), ("239", "Neoplasms"), ("240", "Other"),
    ("E909", "Other"), ("V57", "Other"), ("xyz", "Other"), ("785", "Circulatory")])
def test_families(raw, code, family):
    assert one(raw, diag_1=code).diag_1_group == family


def test_null_rules(raw):
    row = one(raw, diag_1="?", age="[55-65)")
    assert row.diag_1_group is None and row.age_midpoint is None
    unknown = clean.curated(raw({})).selectExpr("* except (insulin, readmitted)", "cast(null as string) AS insulin",
                                                "cast(null as string) AS readmitted")
    row = features.features(unknown).first()
    assert (row.insulin_prescribed, row.readmitted_flag, row.active_medications_count) == (None, None, 0)


def test_feature_table(layers):
    table = layers.features()
    assert tuple(table.columns) == FEATURE_COLUMNS
    quality.raise_on_failure(quality.feature_checks(table, "encounter_id", FLAG_COLUMNS))
    joined = features.join_features(layers.curated(), table)
    beside = layers.encounters().select(*joined.columns)
    assert joined.exceptAll(beside).isEmpty() and joined.count() == beside.count()


def test_sorted_by_key_is_a_total_order(spark, layers):
    valid = layers.valid()
    out = clean.sorted_by_key(clean.curated(valid), valid, 5).withColumn("part", F.spark_partition_id())
    spans = out.groupBy("part").agg(F.min("encounter_id").alias("a"), F.max("encounter_id").alias("b"),
                                    F.count("*").alias("n")).orderBy("part").collect()
    assert len(spans) == 5 and all(x.b < y.a for x, y in zip(spans, spans[1:]))
    assert max(s.n for s in spans) < 1.5 * min(s.n for s in spans)
    assert sum(s.n for s in spans) == clean.curated(valid).count()
    nothing = valid.limit(0)
    assert clean.sorted_by_key(clean.curated(nothing), nothing, 5).count() == 0
    assert clean.sorted_by_key(clean.curated(valid), valid, 1).rdd.getNumPartitions() == 1
