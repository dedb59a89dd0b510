"""Wide to long."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident, literal


def melt(df: DataFrame, ids: Iterable[str], columns: Sequence[str], name: str, value: str,
         kind: str = "STRING") -> DataFrame:
    """One row per row and column: ``(ids…, name, value)``, in one scan.

    Same result as ``unpivot``, through one exploded array: the generated code stays small however many columns are
    melted or carried, where an unpivot compiles a projection of every output column per melted column.
    """
    ids = list(ids)
    cells = ", ".join(f"CAST({ident(c)} AS {kind})" for c in columns)
    names = ", ".join(map(literal, columns))
    return df.select(*ids, F.expr(f"posexplode(array({cells})) AS (_position, {ident(value)})")).select(
        *ids, F.expr(f"element_at(array({names}), _position + 1) AS {ident(name)}"), value)
