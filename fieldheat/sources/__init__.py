"""Readers for landed files and writers for the degree-hour table."""
