"""Relational operators: gates, deduplication, joins, metrics, windows, sampling, extraction, retrieval."""
