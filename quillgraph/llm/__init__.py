"""Operators for preparing training data: deduplication, classification, encoding, packing and search at corpus scale."""
