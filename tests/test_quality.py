import pytest

from stayloom.operators import quality
from stayloom.schema import ENCOUNTER_COLUMNS, HOSPITAL_RULES, SOURCE_NAMES, RuleSet


def found(df, rules=HOSPITAL_RULES):
    return {(r.row_id, r.rule_name, r.column_name, r.invalid_value)
            for r in quality.violations(df, rules).collect()}


def test_rule_count():
    rules = HOSPITAL_RULES
    assert (len(rules.required), len(rules.bounds), len(rules.allowed)) == (43, 13, 31)


def test_valid_row_breaks_nothing(raw):
    assert found(raw({})) == set()


def test_bad_values(raw):
    rows = raw({"time_in_hospital": "0", "age": "invalid_age", "readmitted": "UNKNOWN"})
    assert found(rows) == {
        (0, "invalid_numeric_value", "time_in_hospital", "0"), (0, "invalid_category", "age", "invalid_age"),
        (0, "invalid_category", "readmitted", "UNKNOWN")}


def test_missing_forms(raw):
    rows = raw({"encounter_id": "1", "gender": None}, {"encounter_id": "2", "gender": " ? "},
               {"encounter_id": "3", "gender": "\t\n"}, {"encounter_id": "4", "race": None},
               {"encounter_id": "5", "race": "?"}, {"encounter_id": "6", "insulin": " Up "})
    assert found(rows) == {(0, "required_value", "gender", "<NULL>"), (1, "required_value", "gender", " ? "),
                           (2, "required_value", "gender", "\t\n")}


def test_integer_text(raw):
    bad = [" 4 ", "4.0", "1e3", "abc", "99999999999999999999", "-1"]
    rows = raw(*({"encounter_id": str(i), "num_procedures": v} for i, v in enumerate([*bad, "+4", "007"], start=1)))
    assert {f[3] for f in found(rows)} == set(bad)
    lenient = RuleSet(**{**HOSPITAL_RULES.__dict__, "allow_padding": True})
    assert {f[3] for f in found(rows, lenient)} == set(bad) - {" 4 "}


def test_duplicates(raw):
    rows = raw({}, {}, {"patient_nbr": "101"}, {"encounter_id": " 1"}, {"encounter_id": "?"}, {"encounter_id": "?"})
    by_rule = {}
    for row_id, rule, *_ in found(rows):
        by_rule.setdefault(rule, set()).add(row_id)
    assert by_rule["duplicate_encounter_id"] == {0, 1, 2}
    assert by_rule["exact_duplicate_row"] == {0, 1, 4, 5}
    assert by_rule["required_value"] == {4, 5}


def test_row_duplicates_with_nulls_and_no_key(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "a"), (4, None, None), (5, None, None)],
                               "row_id int, x string, y string")
    assert {r.row_id for r in quality.row_duplicates(df, RuleSet(columns=("x", "y"))).collect()} == {1, 2, 4, 5}


def test_split_is_complete_and_disjoint(raw):
    rows = raw({}, {"encounter_id": "2"}, {"encounter_id": "2"}, {"encounter_id": "3", "age": "x"},
               {"encounter_id": "4", "race": "Martian"})
    valid = {r.row_id for r in quality.valid_rows(rows, HOSPITAL_RULES).collect()}
    stored = quality.violations(rows, HOSPITAL_RULES)
    assert valid == {0} == {r.row_id for r in quality.without_violations(rows, stored).collect()}
    quarantine = quality.quarantine(rows, HOSPITAL_RULES)
    assert {r.row_id for r in quarantine.collect()} == {1, 2, 3, 4}
    assert quarantine.columns[6:] == list(ENCOUNTER_COLUMNS)
    same = quality.quarantine_from(stored, rows, HOSPITAL_RULES)
    assert sorted(map(str, same.drop("rejected_at").collect())) == sorted(
        map(str, quarantine.drop("rejected_at").collect()))


def test_hot_key_keeps_every_copy(spark, raw):
    """A third of all rows under one key: nothing is dropped or capped."""
    rows = raw(*({"encounter_id": "7" if i % 3 == 0 else str(1000 + i)} for i in range(900)))
    got = quality.violations(rows, HOSPITAL_RULES).groupBy("rule_name").count().collect()
    assert {r["rule_name"]: r["count"] for r in got} == {"duplicate_encounter_id": 300, "exact_duplicate_row": 300}


def test_rules_under_published_names(raw):
    renamed = raw({"a1c_result": "bad", "glyburide_metformin": "Maybe"}).withColumnsRenamed(SOURCE_NAMES)
    rules = HOSPITAL_RULES.renamed(SOURCE_NAMES)
    assert {f[2] for f in found(renamed, rules)} == {"A1Cresult", "glyburide-metformin"}
    assert quality.valid_rows(renamed, rules).count() == 0


def test_missing_columns(raw):
    assert quality.missing_columns(raw({}).drop("readmitted", "age"), ENCOUNTER_COLUMNS) == ["age", "readmitted"]
    with pytest.raises(ValueError, match="readmitted"):
        quality.require_columns(raw({}).drop("readmitted"), ENCOUNTER_COLUMNS)
    presence = quality.column_presence(raw({}).drop("age"), ("age", "race")).collect()
    assert {r.column_name: r.present for r in presence} == {"age": False, "race": True}


def test_totals_and_summary(raw):
    rows = raw({}, {}, {"encounter_id": "2", "age": "x", "gender": "y"}, {"encounter_id": "3"})
    stored = quality.violations(rows, HOSPITAL_RULES)
    assert quality.run_totals(rows, stored).first().asDict() == {
        "total_rows": 4, "valid_rows": 1, "rejected_rows": 3, "total_violations": 6, "duplicate_rows": 2,
        "valid_rate_percent": 25.0}
    top = quality.violation_summary(stored).first()
    assert top.violation_count == 2
    missing = {r.column_name: r.missing_rate_percent for r in quality.missing_summary(rows, ("weight", "age")).collect()}
    assert missing == {"weight": 100.0, "age": 0.0}


def test_empty_input(raw):
    rows = raw({}).filter("row_id < 0")
    stored = quality.violations(rows, HOSPITAL_RULES)
    assert quality.run_totals(rows, stored).first().valid_rate_percent == 0.0
    assert quality.missing_summary(rows, ("age",)).first().missing_rate_percent == 0.0
    with pytest.raises(ValueError, match="not_empty"):
        quality.raise_on_failure(quality.not_empty(rows))


def test_checks(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (None, 2), (None, None)], "k int, f int")
    got = {r.check_name: r.failed_rows for r in quality.feature_checks(df, "k", ("f",)).collect()}
    assert got == {"not_empty": 0, "key_not_null": 2, "key_unique": 2, "domain_f": 1}
    parent = spark.createDataFrame([(1,)], "k int")
    assert quality.foreign_keys(df, "f", parent, "k", "fk").first().failed_rows == 2


def test_reconcile(spark):
    a, b = spark.range(5), spark.range(5).union(spark.range(1))
    assert quality.reconcile(a, a, "id").first().reconciled
    assert not quality.reconcile(a, b, "id").first().reconciled
