"""Operators for training-data pipelines: deduplication, model-based filters,
decontamination, tokenisation, formatting and sharding of text collections."""
