"""Spark-native analytics for live and historic event feeds."""
