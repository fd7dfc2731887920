"""Spark-native analytics for curated knowledge bases."""
