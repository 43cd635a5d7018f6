"""Operators for text and training-data preparation. Nothing outside this package imports it."""
