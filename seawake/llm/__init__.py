"""Operators for training-data corpora: deduplication, filters, tokens and packing."""
