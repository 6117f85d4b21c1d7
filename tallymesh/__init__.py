"""Spark-native analytics over sparse count matrices, embeddings and neighbour graphs."""

__version__ = "0.1.0"
