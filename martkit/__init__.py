"""Subscription data marts on Spark: history joins, pick-best rows, slice loads, name rewriting."""

__version__ = "0.1.0"
