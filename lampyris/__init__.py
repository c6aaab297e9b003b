"""Spark-native analytics for city lighting assets, repair requests and field suppliers."""
