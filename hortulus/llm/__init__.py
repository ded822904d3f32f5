"""Operators that prepare text and records as training data."""
