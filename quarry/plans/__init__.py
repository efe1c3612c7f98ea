"""Registered queries over the driver tables, each with its DuckDB oracle where SQL can
state the same result.  Importing this package fills the registry."""

from quarry.plans.registry import ORACLE, QUERIES, register
from quarry.plans import tabular, textual, vectorial, models, transfers  # noqa: F401  (registration)

__all__ = ["ORACLE", "QUERIES", "register"]
