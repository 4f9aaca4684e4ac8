"""Operators of a training-data pipeline: scoring, filtering, dedup, packing."""
