"""All named queries."""

from chatterlens.plans import dashboard, ingest, kept, learning, streams  # noqa: F401
from chatterlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
