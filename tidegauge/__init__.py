"""Anomaly detection on sensor readings, as Spark DataFrame operators."""
