"""Spark-native silver/gold analytics for contest and timing data."""
