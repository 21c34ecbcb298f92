"""Operators for training corpora: filters, search, deduplication, scoring, mixing and packing of documents."""
