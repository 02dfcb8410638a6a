"""Spark-native engine for hierarchical drawing evidence."""
