"""Spark-native analytics for keypoint sequences."""
