"""Spark-native analytics for weighted sky-survey streams."""
