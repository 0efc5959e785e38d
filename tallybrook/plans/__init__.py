"""The jobs: cleaning, lake enrichment, bronze, silver, gold, indicators, checks."""
