"""Operators for training-data pipelines: deduplication, quality, secrets, scoring, token output."""
