"""Queries over the driver tables, each with the SQL it must agree with."""

from catalog import annotation, branches, documents, exports, files, geometry, manifests, projections, replies, sampling, stores  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
