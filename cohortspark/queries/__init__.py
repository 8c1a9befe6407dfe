"""All registered queries."""

from cohortspark.queries import modelling, preparation, regular, summaries, training  # noqa: F401
from cohortspark.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
