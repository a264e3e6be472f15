"""Registered queries, grouped as in the operator inventory."""

from retropanel.queries import q_expressions, q_models, q_panel, q_quality, q_shapes, q_sources, q_statistics, views  # noqa: F401
from retropanel.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
