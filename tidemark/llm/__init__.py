"""Operators for training-data pipelines: clean, match, score and encode very large text tables."""
