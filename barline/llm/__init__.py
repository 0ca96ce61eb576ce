"""Operators for preparing training data: duplicates, leaks, languages, archives, packing."""
