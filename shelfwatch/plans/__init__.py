"""Composite pipelines built from the operators (user-level API)."""
