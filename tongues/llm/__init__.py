"""Operators of a training-data pipeline: personal data, duplicates, language, mixing, tokens, search, shards."""
