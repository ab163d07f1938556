"""Spark-native corpus analytics: evidence-first text operators on DataFrames."""
