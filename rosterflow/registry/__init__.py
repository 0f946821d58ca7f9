"""Registered queries and their checks."""

from rosterflow.registry import columns, figures, files, reports, streams, templates, temporal
from rosterflow.registry.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "columns", "figures", "files", "reports", "streams", "templates", "temporal"]
