"""Electricity-meter analytics expressed as PySpark DataFrame and streaming jobs."""
