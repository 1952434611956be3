"""Spark-native retail catalogue engine."""
