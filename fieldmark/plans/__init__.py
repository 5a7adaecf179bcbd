"""Whole templates as short compositions of the operators."""
