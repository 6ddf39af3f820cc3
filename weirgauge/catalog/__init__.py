"""All named queries, grouped by topic."""

from . import events, examples, live, models, quality, scalars, stored, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
