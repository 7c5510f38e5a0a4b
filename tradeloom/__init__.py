"""Unify repeated marketplace extracts into clean staged tables with Spark."""

from tradeloom.config import Config, Feed

__all__ = ["Config", "Feed"]
