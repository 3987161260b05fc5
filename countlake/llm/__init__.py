"""Operators of a training-data pipeline: deduplication, archives, filters, tokens, search, mixing."""
