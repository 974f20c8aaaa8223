"""Every operator bound to the test tables, each with an independent SQL oracle."""

from __future__ import annotations

from gildmill.queries import cleaning, jobs, relational, searching, storage
from gildmill.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "jobs", "relational", "searching", "storage"]
