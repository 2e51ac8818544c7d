"""Operators for building training data: search, scoring, scans, deduplication, packing, extraction."""
