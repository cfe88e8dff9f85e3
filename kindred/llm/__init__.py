"""Operators for large training corpora: packing, extraction, filtering, de-duplication, search, sharding, models."""
