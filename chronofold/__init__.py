"""Interval analytics on Spark: DataFrame-in, DataFrame-out operators over time intervals."""

__version__ = "0.1.0"
