"""Tidemark: change-data-capture lakehouse tables as Spark DataFrame operators and streaming jobs."""

from tidemark.spec import ScdSpec

__all__ = ["ScdSpec"]
