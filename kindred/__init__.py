"""Spark-native business entity resolution and training-data preparation."""
