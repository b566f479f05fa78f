"""Operators of a training-data pipeline, on the public functions of Spark."""
