"""Operators for building training corpora from large text tables."""
