"""Spark-native curation and analytics for traces of coding agents."""
