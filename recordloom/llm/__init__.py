"""Operators for building training corpora: scans, deduplication, mixing, scoring, packing."""
