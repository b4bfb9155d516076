"""Compositions of operators into whole computations."""
