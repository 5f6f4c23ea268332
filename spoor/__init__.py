"""Spark-native analytics over textual provenance graphs."""
