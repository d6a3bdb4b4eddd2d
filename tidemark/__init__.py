"""Sensor and metering time series on PySpark."""
