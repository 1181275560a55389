"""Operators for training-data pipelines: sharding, tokens, deduplication, quality."""
