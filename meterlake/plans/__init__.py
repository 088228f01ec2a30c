"""Composite jobs over the operators."""
