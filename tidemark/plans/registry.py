"""Every registered query and its SQL, by name."""

from __future__ import annotations

from tidemark.plans import diff_queries, document_queries, misc_queries, ops_queries, planning_queries, range_queries  # noqa: F401
from tidemark.plans.base import ORACLES, QUERIES  # noqa: F401
