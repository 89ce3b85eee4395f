"""Registered queries over the given tables, each next to SQL that must give the same rows."""

from tidemark.plans import aggregates, joins, loads, ordered, scalars, scans, streams, writes  # noqa: F401
from tidemark.plans.registry import PLANS

__all__ = ["PLANS"]
