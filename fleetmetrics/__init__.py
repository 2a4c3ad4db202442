"""Spark-native analytics for equipment telemetry and store operations."""
