"""Operators for preparing training text: deduplication, filtering, extraction, mixing and packing."""
