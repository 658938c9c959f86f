"""Seasonal production analytics as Spark DataFrame operators."""

from trapiche.config import DEFAULT_SPEC, FeedSpec

__all__ = ["DEFAULT_SPEC", "FeedSpec"]
