"""Declarations: field mappings and query descriptions."""
