"""Operators for preparing training data: sharding, search, deduplication, extraction, packing, labelling."""
