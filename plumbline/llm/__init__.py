"""Operators for preparing training data: duplicates, filters, archives, mixing, token files."""
