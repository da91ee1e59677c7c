"""All registered queries."""

from riskloom.plans import catalog_metrics, catalog_models, catalog_tables  # noqa: F401
from riskloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
