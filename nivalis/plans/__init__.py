"""Queries of the library over the given tables."""

from __future__ import annotations


def all_queries():
    """Registered queries and their SQL."""
    from nivalis.plans import grid_queries, registry, relational_queries, scalar_queries, series_queries, source_queries  # noqa: F401

    return registry.QUERIES, registry.SQL
