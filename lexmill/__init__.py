"""Spark-native text, document and bibliographic analytics."""
