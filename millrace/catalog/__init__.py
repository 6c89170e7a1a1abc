"""Every operator as a query over the test tables, most with SQL for the same rows."""

from __future__ import annotations

from millrace.catalog import clusters, counts, features, models, splits, tables
from millrace.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "clusters", "counts", "features", "models", "splits", "tables"]
