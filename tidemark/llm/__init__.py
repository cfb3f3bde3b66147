"""Operators of a training-data pipeline, each with a registered query."""
