"""Operators, grouped by what they work on (see README for the id map)."""
