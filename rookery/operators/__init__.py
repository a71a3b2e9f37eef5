"""Operators on keyed records: merging, joining, publishing, reporting, scheduling."""
