"""Siltstone: curation of text and source-code corpora on Spark DataFrames."""

__version__ = "0.1.0"
