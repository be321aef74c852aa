"""All registered queries."""

from __future__ import annotations

from specloom.plans import geometry_queries, html_queries, incremental_queries, io_queries, layout_queries, mapping_queries, table_queries  # noqa: F401
from specloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
