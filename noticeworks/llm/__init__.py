"""Operators for training-data pipelines: mixing, cleaning, search, scoring, packing and token files."""
