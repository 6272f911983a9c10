"""Spark-native urban exposure analytics: DataFrame operators over street graphs, samples and sunlight facts."""
