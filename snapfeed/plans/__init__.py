"""Whole runs: bounds, feed and commit together."""

from .loaders import ContentLoader, DocumentLoader, PathLoader
from .run import IncrementalRun

__all__ = ["ContentLoader", "DocumentLoader", "IncrementalRun", "PathLoader"]
