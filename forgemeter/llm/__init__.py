"""Operators for training-data corpora: cleaning, deduplication, mixing, tokens and search."""
