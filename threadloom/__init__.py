"""Spark-native engine for question-and-answer corpora."""

__version__ = "0.1.0"
