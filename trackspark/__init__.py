"""Spark-native curation of time-series recordings and their annotations."""
