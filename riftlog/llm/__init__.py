"""Operators for preparing training data: mixing, counting, filtering, deduplication."""
