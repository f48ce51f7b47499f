"""Lodestrata: a Spark-native engine that turns text and structured files into facts."""
