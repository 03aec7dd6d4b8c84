"""Queries over the given tables, one or more per operator."""

from siltstone.queries import fields, layers, maps, merges, paging, storage  # noqa: F401
from siltstone.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
