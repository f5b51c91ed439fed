"""Spark-native entity resolution: scans, text functions, blocking joins, pair features, models, metrics."""
