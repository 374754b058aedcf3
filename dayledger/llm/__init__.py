"""Operators for text corpora: deduplication, quality, mixing, counting, packing, vectors, classifiers."""
