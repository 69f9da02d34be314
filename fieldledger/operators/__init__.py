"""Operators: `DataFrame -> DataFrame`."""
