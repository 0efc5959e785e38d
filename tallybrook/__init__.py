"""Retail order analytics on PySpark: cleaning, enrichment, reporting and checks.

Every public function takes and returns DataFrames; nothing runs until the
caller writes or collects, except where a docstring says that a function runs
a job of its own.
"""
