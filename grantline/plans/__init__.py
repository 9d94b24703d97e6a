"""Passes: compositions of operators."""
