"""Spark-native document-corpus engine."""

__version__ = "0.1.0"
