"""Spark jobs for building and studying a versioned corpus of failure reports."""

__version__ = "0.1.0"
