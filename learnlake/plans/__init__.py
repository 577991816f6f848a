"""Registered queries and the staged job."""

from learnlake.plans import evaluation_queries, feature_queries, io_queries, model_queries, quality_queries  # noqa: F401
from learnlake.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
