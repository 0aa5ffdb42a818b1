"""Spark-native engine for source-grounded claims."""
