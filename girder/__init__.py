"""Spark-native query engine over building-information models."""
