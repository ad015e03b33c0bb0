"""Ratings analytics on PySpark: features, statistics, recommenders and scoring."""

__version__ = "0.1.0"
