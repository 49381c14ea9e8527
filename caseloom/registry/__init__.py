"""All registered queries."""

from caseloom.registry import cleaning, learning, process, relational, series, tables, text  # noqa: F401
from caseloom.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
