"""Operators that prepare training data: sharding, cleaning, deduplication, extraction, packing."""
