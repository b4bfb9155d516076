"""Operators that clean, measure and pack a text corpus for training."""
