"""Batch and streaming analytics over media play events, on Spark."""

__version__ = "0.1.0"
