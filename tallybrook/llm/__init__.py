"""Operators for preparing text corpora: deduplication, filtering, mixing, tokens, archives, search."""
