"""Operators for large text collections: cleaning, deduplication, mixing, output."""
