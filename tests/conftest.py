import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stayloom.schema import ENCOUNTER_COLUMNS  # noqa: E402
from stayloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/stayloom-test-warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def layers(spark):
    from stayloom.plans.layers import Layers

    return Layers(spark, "/root/testdata/sf0.001")


VALID_ROW = {
    **dict.fromkeys(ENCOUNTER_COLUMNS, "No"),
    "encounter_id": "1", "patient_nbr": "100", "race": "Caucasian", "gender": "Female", "age": "[50-60)",
    "weight": "?", "payer_code": "?", "medical_specialty": "?", "admission_type_id": "1",
    "discharge_disposition_id": "1", "admission_source_id": "7", "time_in_hospital": "3", "num_lab_procedures": "40",
    "num_procedures": "1", "num_medications": "12", "number_outpatient": "0", "number_emergency": "0",
    "number_inpatient": "0", "diag_1": "250.00", "diag_2": "401", "diag_3": "428", "number_diagnoses": "5",
    "max_glu_serum": "None", "a1c_result": "None", "change": "No", "diabetesmed": "Yes", "readmitted": "NO",
}


@pytest.fixture(scope="session")
def raw(spark):
    """Raw rows from overrides of one valid row; row ids follow the order."""
    def make(*overrides):
        rows = [(i, *({**VALID_ROW, **o}[c] for c in ENCOUNTER_COLUMNS)) for i, o in enumerate(overrides)]
        return spark.createDataFrame(rows, "row_id bigint, " + ", ".join(f"{c} string" for c in ENCOUNTER_COLUMNS))

    return make
