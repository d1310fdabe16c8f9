"""Operators for preparing training text: deduplication, packing, search, filters, formatting."""
