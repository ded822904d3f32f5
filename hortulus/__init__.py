"""A Spark engine that turns line-oriented documents into tables by matching them against a dictionary of names."""

__version__ = "0.1.0"
