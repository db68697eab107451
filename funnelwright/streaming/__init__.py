"""Incremental loads driven by newly landed files."""
