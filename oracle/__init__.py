"""SQL twins of the named queries, for DuckDB on the same tables: written apart from the Spark code."""

from .queries import ORACLES  # noqa: F401
