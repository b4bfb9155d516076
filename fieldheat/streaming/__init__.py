"""Incremental loading of landed readings."""
