"""Ordered text in, validated knowledge base out: a PySpark-native engine."""
