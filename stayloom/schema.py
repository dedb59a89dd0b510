"""Declared schema of the hospital extract: columns, rules and the constants every layer shares."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Names, allowed values, bounds and message texts are part of the
# results and must stay exactly as they are.
# ---------------------------------------------------------------------------

MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin", "glyburide_metformin",
    "glipizide_metformin", "glimepiride_pioglitazone", "metformin_rosiglitazone", "metformin_pioglitazone",
)

DIAGNOSES = ("diag_1", "diag_2", "diag_3")

ENCOUNTER_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id",
    "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", *DIAGNOSES, "number_diagnoses", "max_glu_serum", "a1c_result", *MEDICATIONS,
    "change", "diabetesmed", "readmitted",
)

# Published header names that differ from the snake_case names used after the clean step.
SOURCE_NAMES = {
    "a1c_result": "A1Cresult",
    "diabetesmed": "diabetesMed",
    **{m: m.replace("_", "-") for m in MEDICATIONS if "_" in m},
}

AGE_BRACKETS = (
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
)

REQUIRED_REASON = "La valeur obligatoire est absente."
CATEGORY_REASON = "La valeur ne fait pas partie des catégories autorisées."
KEY_DUPLICATE_REASON = "L'identifiant encounter_id doit être unique."
ROW_DUPLICATE_REASON = "La ligne est un doublon exact."

NUMERIC_BOUNDS = {
    "encounter_id": (1, None, "L'identifiant du séjour doit être un entier positif."),
    "patient_nbr": (1, None, "L'identifiant du patient doit être un entier positif."),
    "admission_type_id": (1, None, "Le type d'admission doit être un identifiant positif."),
    "discharge_disposition_id": (1, None, "Le mode de sortie doit être un identifiant positif."),
    "admission_source_id": (1, None, "La source d'admission doit être un identifiant positif."),
    "time_in_hospital": (1, 14, "La durée du séjour doit être comprise entre 1 et 14 jours."),
    "num_lab_procedures": (0, None, "Le nombre d'analyses ne peut pas être négatif."),
    "num_procedures": (0, None, "Le nombre de procédures ne peut pas être négatif."),
    "num_medications": (0, None, "Le nombre de médicaments ne peut pas être négatif."),
    "number_outpatient": (0, None, "Le nombre de visites externes ne peut pas être négatif."),
    "number_emergency": (0, None, "Le nombre de visites aux urgences ne peut pas être négatif."),
    "number_inpatient": (0, None, "Le nombre d'hospitalisations précédentes ne peut pas être négatif."),
    "number_diagnoses": (1, 16, "Le nombre de diagnostics doit être compris entre 1 et 16."),
}

ALLOWED_VALUES = {
    "race": ("Caucasian", "AfricanAmerican", "Asian", "Hispanic", "Other"),
    "gender": ("Female", "Male"),
    "age": AGE_BRACKETS,
    "max_glu_serum": ("None", "Norm", ">200", ">300"),
    "a1c_result": ("None", "Norm", ">7", ">8"),
    "change": ("Ch", "No"),
    "diabetesmed": ("Yes", "No"),
    "readmitted": ("<30", ">30", "NO"),
    **{m: ("No", "Steady", "Up", "Down") for m in MEDICATIONS},
}

MISSING_TOKENS = ("", "?")
FILL_UNKNOWN = ("race", "weight", "payer_code", "medical_specialty")
UNKNOWN = "Unknown"
ETL_VERSION = "1.0.0"

FREQUENT_PATIENT_VISITS = 3
HIGH_MEDICATION_BURDEN = 15

# ICD-9 families in matching order: (family, [closed numeric ranges]). Codes starting with 250 are Diabetes.
DIABETES_PREFIX = "250"
DIAGNOSIS_FAMILIES = (
    ("Circulatory", ((390, 459), (785, 785))),
    ("Respiratory", ((460, 519), (786, 786))),
    ("Digestive", ((520, 579), (787, 787))),
    ("Injury", ((800, 999),)),
    ("Musculoskeletal", ((710, 739),)),
    ("Genitourinary", ((580, 629), (788, 788))),
    ("Neoplasms", ((140, 239),)),
)

# Discharge codes for death or hospice: never part of model training or scoring.
EXCLUDED_DISCHARGES = (11, 13, 14, 19, 20, 21)

MODEL_NUMERIC = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses",
    "age_midpoint", "total_previous_visits", "healthcare_utilization_score", "patient_complexity_score",
    "active_medications_count", "medication_dosage_changes_count",
)
MODEL_CATEGORICAL = (
    "gender", "race", "admission_type_id", "discharge_disposition_id", "admission_source_id", "max_glu_serum",
    "a1c_result", "change", "diabetesmed", "insulin_prescribed", "diag_1_group",
)
MODEL_TARGET = "readmitted_30_days"
MEDIUM_RISK_QUANTILE, HIGH_RISK_QUANTILE = 0.80, 0.95

CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY = "1999-01-01", "2008-12-31"

REFERENCE_SECTIONS = {
    # section header -> (dimension, id column, description column)
    "admission_type_id": ("dim_admission_type", "admission_type_id", "admission_type_description"),
    "discharge_disposition_id": (
        "dim_discharge_disposition", "discharge_disposition_id", "discharge_disposition_description"),
    "admission_source_id": ("dim_admission_source", "admission_source_id", "admission_source_description"),
}
NO_DESCRIPTION = "Non disponible"

SEVERITY_BANDS = ("Aucune valeur manquante", "Faible", "Modéré", "Élevé", "Critique")

SOURCE_FILE_NAME = "diabetic_data.csv"

# ---------------------------------------------------------------------------

FEATURE_COLUMNS = (
    "encounter_id", "patient_nbr", "readmitted_30_days", "readmitted_flag", "age_midpoint", "total_previous_visits",
    "healthcare_utilization_score", "is_frequent_patient", "active_medications_count",
    "medication_dosage_changes_count", "insulin_prescribed", "high_medication_burden_flag",
    "diag_1_group", "diag_2_group", "diag_3_group", "patient_complexity_score",
)
FLAG_COLUMNS = (
    "readmitted_30_days", "readmitted_flag", "is_frequent_patient", "insulin_prescribed", "high_medication_burden_flag",
)


@dataclass(frozen=True)
class RuleSet:
    """Row rules of one table, as data: any table can be checked by declaring one of these.

    ``bounds`` maps a column to ``(minimum, maximum or None, reason)``; ``allowed`` maps a column to its
    permitted values; ``optional`` columns may be missing; ``key`` must be unique.
    """

    columns: tuple[str, ...]
    key: str | None = None
    bounds: Mapping[str, tuple[int, int | None, str]] = field(default_factory=dict)
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()
    required_reason: str = REQUIRED_REASON
    category_reason: str = CATEGORY_REASON
    key_reason: str = KEY_DUPLICATE_REASON
    row_reason: str = ROW_DUPLICATE_REASON
    allow_padding: bool = False  # accept blanks around integers

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c for c in dict.fromkeys((*self.bounds, *self.allowed)) if c not in self.optional)

    def renamed(self, names: Mapping[str, str]) -> RuleSet:
        def new(c):
            return names.get(c, c)

        return replace(
            self,
            columns=tuple(map(new, self.columns)),
            key=self.key and new(self.key),
            bounds={new(c): r for c, r in self.bounds.items()},
            allowed={new(c): v for c, v in self.allowed.items()},
            optional=frozenset(map(new, self.optional)),
        )


HOSPITAL_RULES = RuleSet(
    columns=ENCOUNTER_COLUMNS,
    key="encounter_id",
    bounds=NUMERIC_BOUNDS,
    allowed=ALLOWED_VALUES,
    optional=frozenset({"race"}),
)
