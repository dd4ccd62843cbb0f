"""Analytical models, serving queries and data-quality checks."""
