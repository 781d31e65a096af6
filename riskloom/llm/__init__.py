"""Operators of a training-data pipeline: near-duplicates, quality, language, archives, mixing, search, tokens, urls."""
