"""All registered queries."""

from checks import daily_query, features_quality, io_queries, ml_queries, silver_gold, stream_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
