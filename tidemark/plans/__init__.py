"""Whole runs: discover, extract, refresh."""
