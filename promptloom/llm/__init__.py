"""Operators for building training corpora at scale. Nothing outside this package imports it."""
