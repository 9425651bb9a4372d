"""Registered queries over the shared test tables, with SQL equivalents."""

from lodestay.suite import analysis_queries, market_queries, quality_queries  # noqa: F401
from lodestay.suite.registry import ORACLES, QUERIES  # noqa: F401
