"""Schemas, readers, writers and the mapping of the test tables."""
