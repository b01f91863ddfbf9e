"""Operators for preparing training data: counts, deduplication, classifiers, mixing, extraction, search."""
