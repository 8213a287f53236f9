"""Operators for preparing training data: deduplication, filters, tokens, search, extraction."""
