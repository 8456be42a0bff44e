"""Operators on text corpora: scoring, cleaning, search, grouping, encoding and packing."""
