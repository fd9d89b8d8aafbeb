"""Spark-native analytics over disclosure records, text and training corpora."""
