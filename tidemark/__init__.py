"""Incremental extraction of semi-structured records as Spark jobs."""

from tidemark.config import StreamConfig

__all__ = ["StreamConfig"]
