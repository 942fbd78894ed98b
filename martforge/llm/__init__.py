"""Operators of a training-data pipeline (language, duplicates, contamination, secrets, tokens, quality, sharding)."""
