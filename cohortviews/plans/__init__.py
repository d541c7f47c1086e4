"""Composed jobs: merges, model tables, label audit, and the query catalogue."""
