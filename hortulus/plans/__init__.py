"""Whole pipelines built of the operators."""
