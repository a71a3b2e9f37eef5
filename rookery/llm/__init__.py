"""Operators that prepare text for training: archives, deduplication, quality, packing, scoring."""
