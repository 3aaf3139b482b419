"""Registered queries over the test tables, with the SQL that checks them."""

from chatterlens.plans import (  # noqa: F401  (importing a module registers its queries)
    text_queries,
    validate_queries,
    keyword_queries,
    session_queries,
    analytics_queries,
    sentiment_queries,
    feature_queries,
    stream_queries,
)
from chatterlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
