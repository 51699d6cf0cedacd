"""Spark-native cleaning, quality gating and corpus preparation for text collections."""

__version__ = "0.1.0"
