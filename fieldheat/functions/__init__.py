"""Column expressions shared by the operators; no user-defined functions."""
