"""Spark-native analytics for economic indicator series."""
