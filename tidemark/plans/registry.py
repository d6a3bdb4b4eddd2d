"""All registered queries of the time-series library, and their SQL."""

from __future__ import annotations

from . import fits, roundtrips  # noqa: F401  (add their queries to those of queries)
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
