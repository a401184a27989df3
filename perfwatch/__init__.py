"""Predictive performance monitoring of service telemetry on PySpark."""
