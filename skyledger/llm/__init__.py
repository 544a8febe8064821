"""Operators of a training-data pipeline: scoring, filtering, matching, formats."""
