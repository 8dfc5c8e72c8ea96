"""Operators of a training-data pipeline, each on whole tables."""
