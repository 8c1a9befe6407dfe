"""Operators for training-data pipelines; nothing else in the package imports them."""

from cohortspark.llm import queries  # noqa: F401
from cohortspark.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
