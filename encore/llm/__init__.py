"""Operators of a training-data pipeline: tokenising, formatting, filtering, deduplication, search, sharding."""
