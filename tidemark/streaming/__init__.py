"""Micro-batch runs over arriving files."""
