"""Operators for large text corpora: quality, deduplication, decontamination, scoring, packing and placement."""
