"""All registered queries of the library and their SQL."""

from siteledger.plans import case_queries, state_queries  # noqa: F401  importing them registers their queries
from siteledger.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
