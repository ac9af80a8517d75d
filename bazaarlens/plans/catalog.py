"""All registered queries."""
from bazaarlens.plans import functions_catalog, pages_catalog, reports_catalog, tables_catalog  # noqa: F401
from bazaarlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
