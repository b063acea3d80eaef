"""Spark-native document-table analytics."""
