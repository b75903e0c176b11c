"""Spark-native data engine for text-classification platforms."""

__version__ = "0.1.0"
