"""Queries over the test tables, one per operator group."""

from siltstone.queries import builds, ingest, keys, relational, scalars, shapes, stored, tables  # noqa: F401
from siltstone.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
