"""Incremental loading of newly landed files."""
