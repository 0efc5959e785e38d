"""Reusable DataFrame operators: survivor choice, joins, ranks, upsert, checks."""
