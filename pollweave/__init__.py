"""Spark-first analytics for popularity polls and the texts around them."""

__version__ = "0.1.0"
