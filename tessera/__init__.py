"""Tessera: Spark-native hybrid retrieval, evaluation and corpus analytics."""
