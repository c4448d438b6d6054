"""Bulk input and the index tables."""
