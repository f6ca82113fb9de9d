"""Registered queries: one per inventory id, with its oracle where SQL can express it."""

from tripmill.catalog import (  # noqa: F401
    aggregates, functions, joins, materialisation, projections, quality, regression, sinks,
    sources, streams, udfs)
from tripmill.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
