"""Text and number predicates over raw text columns.

The arguments named ``x`` are column names or SQL expressions. The ``*_sql`` builders return SQL text, so that a rule
set over fifty columns reaches the JVM as one expression instead of thousands of small calls; the other functions
wrap them as columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MISSING_TOKENS

WHITESPACE = " \t\n\r\f\v"
INTEGER_TEXT = r"^[+-]?[0-9]+\z"  # $ would also match before a final line break


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def listed(values: Iterable[object]) -> str:
    return ", ".join(map(literal, values))


# --- SQL text ----------------------------------------------------------------------------------------------------


def strip_sql(x: str) -> str:
    return f"btrim({x}, '{WHITESPACE}')"


def missing_sql(x: str) -> str:
    return f"({x} IS NULL OR {strip_sql(x)} IN ({listed(MISSING_TOKENS)}))"


def integer_sql(x: str, allow_padding: bool = False) -> str:
    text = strip_sql(x) if allow_padding else x
    return f"(CASE WHEN {text} RLIKE {literal(INTEGER_TEXT)} THEN try_cast({text} AS BIGINT) END)"


def inside_sql(x: str, low: int, high: int | None, allow_padding: bool = False) -> str:
    number = integer_sql(x, allow_padding)
    return f"coalesce({number} >= {low}, false)" if high is None else (
        f"coalesce({number} BETWEEN {low} AND {high}, false)")


def out_of_bounds_sql(x: str, low: int, high: int | None, allow_padding: bool = False) -> str:
    return f"(NOT {missing_sql(x)} AND NOT {inside_sql(x, low, high, allow_padding)})"


def not_allowed_sql(x: str, allowed: Iterable[str]) -> str:
    return f"(NOT {missing_sql(x)} AND {strip_sql(x)} NOT IN ({listed(allowed)}))"


def lookup_sql(x: str, values: Mapping[object, object], otherwise: object = None) -> str:
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in values.items())
    return f"(CASE {x} {cases} ELSE {literal(otherwise)} END)"


# --- columns -----------------------------------------------------------------------------------------------------


def strip(x: str) -> Column:
    """Strip all surrounding whitespace (``trim`` would strip blanks only)."""
    return F.expr(strip_sql(x))


def is_missing(x: str) -> Column:
    """NULL, empty or ``?`` after stripping. Never NULL itself."""
    return F.expr(missing_sql(x))


def null_if_missing(x: str, known: Iterable[str] = ()) -> Column:
    """Stripped text, with missing tokens turned into NULL. ``known`` texts are stripped and not missing, so they are only
    compared."""
    as_is = f"WHEN {x} IN ({listed(known)}) THEN {x} " if known else ""
    return F.expr(f"CASE {as_is}WHEN {strip_sql(x)} NOT IN ({listed(MISSING_TOKENS)}) THEN {strip_sql(x)} END")


def null_if_token(x: str, tokens: Iterable[str]) -> Column:
    """Unstripped text, NULL where it equals one of the given null tokens."""
    return F.expr(f"CASE WHEN {x} NOT IN ({listed(tokens)}) THEN {x} END")


def strict_integer(x: str, allow_padding: bool = False) -> Column:
    """Integer value of a text; NULL unless it is nothing but a signed integer that fits 64 bits."""
    return F.expr(integer_sql(x, allow_padding))


def out_of_bounds(x: str, low: int, high: int | None, allow_padding: bool = False) -> Column:
    """Present, but not an integer within the closed bounds. Never NULL."""
    return F.expr(out_of_bounds_sql(x, low, high, allow_padding))


def not_allowed(x: str, allowed: Iterable[str]) -> Column:
    """Present, but (stripped) not one of the allowed values. Never NULL."""
    return F.expr(not_allowed_sql(x, allowed))


def lookup(x: str, values: Mapping[object, object], otherwise: object = None) -> Column:
    """Value map with a default for everything else (NULL included)."""
    return F.expr(lookup_sql(x, values, otherwise))


def capped(c: str | Column, cap: int) -> Column:
    """Number as text, everything from the cap on as ``cap+``."""
    return F.when(col(c) >= cap, f"{cap}+").otherwise(col(c).cast("string"))


def flag(condition: str) -> Column:
    """0/1 of a comparison; an unknown comparison stays NULL."""
    return F.expr(f"CAST({condition} AS INT)")


def one_of(x: str, values: Iterable[str]) -> Column:
    return flag(f"({x} IN ({listed(values)}))")


def as_category(x: str) -> Column:
    """Text of any value; NULL becomes the category ``None``."""
    return F.expr(f"coalesce(CAST({x} AS STRING), 'None')")


def error_text(c: str | Column) -> Column:
    """Error messages are kept to 4,000 characters."""
    return F.substring(col(c), 1, 4000)


def table_cell(c: str | Column) -> Column:
    """Text that may stand inside a pipe-separated table cell."""
    return F.translate(col(c).cast("string"), "|", "/")
