"""Spark-native operators for layered (bronze / silver / gold) tables."""
