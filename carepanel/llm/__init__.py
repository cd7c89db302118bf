"""Operators for preparing training data: deduplication, language, tokens, shards, contamination, secrets, search."""
