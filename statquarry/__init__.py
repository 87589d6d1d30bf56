"""Spark-native profiling, clustering and valuation of wide entity tables."""

__version__ = "0.1.0"
