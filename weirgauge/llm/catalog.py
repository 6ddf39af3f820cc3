"""Imports every operator so that its query is registered."""

from . import (  # noqa: F401
    alignment,
    decontaminate,
    language,
    lexical,
    licences,
    neighbours,
    packing,
    quality,
    sharding,
    simhash,
    substrings,
    token_files,
    warc,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
