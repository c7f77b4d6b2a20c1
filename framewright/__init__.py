"""Framewright: a Spark engine that curates picture-and-caption datasets."""

__version__ = "0.1.0"
