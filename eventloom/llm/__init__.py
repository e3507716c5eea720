"""Operators for training-data pipelines, and their named queries."""
