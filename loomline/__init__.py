"""Loomline: a PySpark-native engine for curating text and parallel-text corpora."""
