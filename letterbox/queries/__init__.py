"""All registered queries with their answers in SQL."""

from . import parsing, streams, writing  # noqa: F401  (register on import)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
