"""Composite reads and jobs built from the operators."""
