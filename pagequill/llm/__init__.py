"""Operators for building training data: deduplication, mixing, filters, tokens, archives."""
