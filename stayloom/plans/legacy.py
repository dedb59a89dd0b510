"""Cleaning of the legacy stay extract: lenient dates and numbers, yes/no and sex codes, constant fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# Fixed values of the legacy extract.
DATES = ("date_entree", "date_sortie")
YES_NO = ("diabete", "hypertension", "cardiopathie", "dialyse", "passage_labo", "passage_cardio", "complications",
          "infection", "rehospitalise_30j")
NUMBERS = ("age", "duree_sejour", "creatinine_mg_l", "uree_g_l", "potassium_mmol_l", "sodium_mmol_l",
           "hemoglobine_g_dl", "crp_mg_l", "albumine_g_l", "dfg_ml_min", "nb_hospitalisations_precedentes",
           "duree_hospitalisation_precedente_moy", "delai_depuis_derniere_hosp_jours", "nombre_analyses_labo",
           "score_risque_clinique", "delai_rehospitalisation_jours")
FILLS = {"duree_hospitalisation_precedente_moy": 0.0, "delai_depuis_derniere_hosp_jours": 999.0,
         "delai_rehospitalisation_jours": 0.0}
#: Formats the first date of a column may elect, tried in this order: 1/2/1999 is the second of January, 25/2/1999 can
#: only begin with the day.
DATE_FORMATS = (
    "yyyy-M-d", "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m", "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d'T'H:m:s.SSSSSS", "yyyy/M/d", "yyyy/M/d H:m:s", "M/d/yyyy", "M/d/yyyy H:m:s", "d/M/yyyy", "d/M/yyyy H:m:s",
    "yyyyMMdd",
)
#: Texts that stand for no date at all; they elect nothing.
NO_DATE = ("", "nan", "NaN", "NAN", "nat", "NaT", "NAT")
NUMBER_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_ELECTED = "_elected_formats"
NEEDED = ("age", "date_entree", "date_sortie", "rehospitalise_30j")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip().lower() for c in df.columns))


def _in_format(text: Column, number: int) -> Column:
    return F.try_to_timestamp(text, F.lit(DATE_FORMATS[number]))


def elected_formats(df: DataFrame, columns, row_order: Column) -> Column:
    """A struct with, for each column, the number in DATE_FORMATS of the format of its first date in row order: a scalar
    subquery. Keep it as a column of the table before its fields are used, so that it is planned once.

    -1 where that first text has none of the formats. One pass over the date columns, with partial aggregates.
    """
    named = df.select(row_order.alias("_row"), *columns)
    firsts = named.agg(*(F.min(F.when(
        F.col(c).isNotNull() & ~F.col(c).isin(*NO_DATE), F.struct("_row", F.col(c).alias("text")))).alias(c)
        for c in columns))

    def number(text: Column) -> Column:
        return F.coalesce(*(F.when(_in_format(text, i).isNotNull(), i) for i in range(len(DATE_FORMATS))), F.lit(-1))

    return firsts.select(F.struct(*(number(F.col(f"{c}.text")).alias(c) for c in columns)).alias("n")).scalar()


def lenient_date(c: str, elected: Column | None = None) -> Column:
    """Day of a date in the elected format; any other text is unknown. Without an elected format every text is read by
    the first of DATE_FORMATS it has. Only the branch of the elected format is evaluated."""
    text = F.col(c)
    each = F.coalesce(*(_in_format(text, i) for i in range(len(DATE_FORMATS))))
    if elected is None:
        return each.cast("date")
    readers = F.when(elected == -1, each)
    for i in range(len(DATE_FORMATS)):
        readers = readers.when(elected == i, _in_format(text, i))
    return readers.cast("date")


def lenient_number(c: str) -> Column:
    """Plain decimal or scientific notation; Spark's cast alone would take ``1d`` and ``1f`` for numbers as well."""
    text = strip(c)
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def yes_no(c: str) -> Column:
    text = F.lower(strip(c))
    return F.when(text == "oui", 1).when(text == "non", 0)


def sex_code(c: str) -> Column:
    text = F.upper(strip(c))
    return F.when(text == "H", 1).when(text == "F", 0)


def legacy_clean(df: DataFrame, row_order: str | None = None) -> DataFrame:
    """The whole chain. Columns the extract does not have are left alone, fills included.

    The first date of a column, by ``row_order``, decides the format of the column; dates in any other are unknown.
    Without a column to order by, rows count in the order they are read, which is that of the file.
    """
    df = lower_names(df)
    order = F.col(row_order) if row_order else F.monotonically_increasing_id()
    df = df.withColumn(_ELECTED, elected_formats(df, DATES, order))
    df = df.withColumns({c: lenient_date(c, F.col(_ELECTED)[c]) for c in DATES}).drop(_ELECTED)
    if "duree_sejour" not in df.columns:
        df = df.withColumn("duree_sejour", F.datediff("date_sortie", "date_entree"))
    changed = {c: yes_no(c) for c in YES_NO if c in df.columns}
    if "sexe" in df.columns:
        changed["sexe"] = sex_code("sexe")
    changed |= {c: lenient_number(c) for c in NUMBERS if c in df.columns}
    df = df.withColumns(changed)
    return df.na.fill({c: v for c, v in FILLS.items() if c in df.columns}).na.drop(subset=list(NEEDED))
