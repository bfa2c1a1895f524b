"""Operators for preparing language-model training data: packing, extraction, scoring, joins, scans and search."""
