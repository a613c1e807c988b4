"""Telemetry analytics on Spark DataFrames."""
