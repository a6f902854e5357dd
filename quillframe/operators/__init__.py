"""Operators on frames."""
